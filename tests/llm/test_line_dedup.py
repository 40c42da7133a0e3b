import random
from pathlib import Path

from basket_marts.llm import line_dedup
from basket_marts.llm.line_dedup import drop_recurring_lines
from basket_marts.session import session_root

SCHEMA = "doc_id bigint, text string"


def kept(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return {r.doc_id: r.text for r in drop_recurring_lines(frame, **options).collect()}


def test_recurring_lines_stay_in_the_first_document(spark):
    menu = "Home About Contact and other pages"
    own = ["One text.", "Another text of its own.", "And a third, which differs from both."]
    rows = [(i, f"{menu}\n{text}") for i, text in enumerate(own)]
    assert kept(spark, rows) == {0: rows[0][1], 1: own[1], 2: own[2]}


def test_scratch_data_goes_when_the_dropped_lines_are_known(spark):
    root = Path(session_root(spark))
    rows = [(i, f"Home About Contact and other pages\n{chr(97 + i)} text.") for i in range(4)]
    before = set(root.iterdir())
    dropped = drop_recurring_lines(spark.createDataFrame(rows, SCHEMA))
    left = set(root.iterdir()) - before
    assert [path.name.split("-")[0] for path in left] == ["gone"]
    found = [(r.doc_id, r.n_dropped) for r in dropped.orderBy("doc_id").collect()]
    assert found == [(0, 0), (1, 1), (2, 1), (3, 1)]


def test_two_documents_are_too_few(spark):
    rows = [(1, "the same line in both"), (2, "the same line in both")]
    assert kept(spark, rows) == dict(rows)
    assert kept(spark, rows, min_docs=2) == {1: rows[0][1], 2: ""}


def test_variable_fields(spark):
    line = "login to the server by user {} from {} today"
    rows = [
        (1, line.format("anna", "10.0.0.1")),
        (2, line.format("bert", "10.0.0.2")),
        (3, line.format("carl", "10.7.0.3")),
        (4, "login to the server of our house by the sea"),
        (5, "posted on 2024-01-02"),
        (6, "posted on 2023-11-12"),
        (7, "posted  on\t1999-12-31 "),
    ]
    assert kept(spark, rows) == {
        1: rows[0][1], 2: "", 3: "", 4: rows[3][1], 5: rows[4][1], 6: "", 7: "",
    }


def test_lines_that_share_too_little_are_no_template(spark):
    rows = [(i, f"in the end {a} {b} {c} {d}") for i, (a, b, c, d) in enumerate(
        [("we", "all", "went", "home"), ("she", "had", "some", "tea"), ("it", "may", "be", "so")]
    )]
    assert kept(spark, rows) == dict(rows)


def test_repeats_within_one_document_stay(spark):
    text = "again and again\nagain and again\n\n\nagain and again"
    assert kept(spark, [(1, text), (2, "other")]) == {1: text, 2: "other"}


def test_long_shared_passages(spark):
    passage = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(i, f"start {name}\n{passage}\nend {name}") for i, name in enumerate("xyzuv")]
    texts = kept(spark, rows)
    assert [passage in texts[i] for i in range(5)] == [True, False, False, False, False]


def test_odd_rows(odd):
    result = drop_recurring_lines(odd)
    assert result.columns == [c for c in odd.columns if c != "n_lines"][:0] + list(
        dict.fromkeys([*odd.columns, "n_lines", "n_dropped"])
    )
    key = lambda r: (str(r.doc_id), r.text or "")
    rows, before = sorted(result.collect(), key=key), sorted(odd.collect(), key=key)
    assert len(rows) == len(before)
    # Only the line of documents 1, 6 and 6 recurs.
    assert [r.text for r in rows if r.doc_id == 6] == ["", ""]
    assert [r.text for r in rows if r.doc_id != 6] == [r.text for r in before if r.doc_id != 6]
    assert {r.n_lines for r in rows if r.text is None} == {0}
    assert [r.leaf for r in rows] == [r.leaf for r in before]


def test_no_rows(no_rows):
    assert drop_recurring_lines(no_rows).collect() == []


def test_only_ids_that_are_null(spark):
    rows = [(None, "the very same line")] * 3
    frame = spark.createDataFrame(rows, SCHEMA)
    assert [r.text for r in drop_recurring_lines(frame).collect()] == ["the very same line"] * 3


def test_rare_variants_go_with_the_common_line(spark):
    words = "please read to the end of these rules before you post here".split()
    rows = [(i, " ".join(words)) for i in range(10)]
    for i, place in enumerate((4, 7, 10)):
        rows.append((10 + i, " ".join([*words[:place], f"new{'abc'[i]}", *words[place + 1 :]])))
    other = " ".join([*words[:5], "and", "now", "something", *words[8:]])
    texts = kept(spark, [*rows, (20, other)])
    assert texts == {0: rows[0][1], **{i: "" for i in range(1, 13)}, 20: other}


def test_variants_without_a_common_line(spark):
    words = "please read to the end of these rules before you post here".split()
    rows = [(i, " ".join([*words[:p], f"new{'abcd'[i]}", *words[p + 1 :]])) for i, p in enumerate((4, 6, 8, 10))]
    assert kept(spark, rows) == {0: rows[0][1], 1: "", 2: "", 3: ""}


def test_passages_recur_from_two_documents_on(spark):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    near = " ".join([*words[:20], "other", *words[21:]])
    short = " ".join(words[:49])
    rows = [(1, f"first\n{' '.join(words)}"), (2, f"second\n{' '.join(words)}"), (3, near)]
    assert kept(spark, rows) == {1: rows[0][1], 2: "second", 3: ""}
    assert kept(spark, rows[::2]) == {1: rows[0][1], 3: ""}
    assert kept(spark, [(1, short), (2, short)]) == {1: short, 2: short}


def test_a_variant_meets_the_most_frequent_template_of_each_run(spark):
    """Of two templates that share a run with it, the line is compared with the commoner one."""
    common = "go to the main page and then look for all of these".split()
    other = [*common[:6], "now", "stop", "here", "until", "it", "rains"]
    rows = [(i, " ".join(common)) for i in range(5)] + [(10 + i, " ".join(other)) for i in range(3)]
    rows += [(20, " ".join([*common[:11], "those"])), (21, " ".join([*other[:11], "pours"]))]
    texts = kept(spark, rows)
    assert [i for i, t in texts.items() if t] == [0, 10]


def test_a_leaf_of_many_lines_takes_time_in_proportion(spark):
    """Each line is in three documents and differs from all others in two words."""
    from time import perf_counter

    def seconds(n):
        words = "the same words are at the head of every line in".split()
        lines = [" ".join([*words, f"a{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", f"b{chr(97 + i % 25)}{chr(97 + i // 25 % 25)}{chr(97 + i // 625)}"]) for i in range(n)]
        rare = [line.replace("every", f"own{chr(97 + i % 26)}{chr(97 + i // 26)}") for i, line in enumerate(lines[: n // 4])]
        rows = [(i, "\n".join(lines)) for i in range(3)] + [(9, "\n".join(rare))]
        frame = spark.createDataFrame(rows, SCHEMA)
        begun = perf_counter()
        found = {r.doc_id: r.n_dropped for r in drop_recurring_lines(frame).collect()}
        assert found == {0: 0, 1: n, 2: n, 9: n // 4}
        return perf_counter() - begun

    seconds(500)
    small, large = seconds(2000), seconds(8000)
    assert large < 3 * small + 2


def test_a_variant_meets_a_template_that_is_not_the_most_frequent(spark):
    """Each run of the variant is in a commoner template, and in the one that it goes with."""
    words = "go to the one two three four five six seven eight nine".split()
    changed = [*words[:11], "ten"]
    rows = [(i, " ".join(words)) for i in range(3)] + [(10, " ".join(changed))]
    others = ["alpha beta gamma", "delta epsilon zeta", "eta theta iota"]
    for i in range(3):
        other = [*words[:3], *" ".join(others).split()]
        other[3 + 3 * i : 6 + 3 * i] = changed[3 + 3 * i : 6 + 3 * i]
        rows += [(20 + 10 * i + k, " ".join(other)) for k in range(8)]
    texts = kept(spark, rows)
    assert [i for i, text in texts.items() if text] == [0, 20, 30, 40]


def near_by_hand(rare, recurring):
    found = {}
    for leaf, line in rare:
        for other_leaf, template, keeper in recurring:
            pairs = list(zip(line.split(), template.split(), strict=False))
            if leaf == other_leaf and sum(a == b for a, b in pairs) >= 0.8 * len(pairs):
                found[line] = min(keeper, found.get(line, keeper))
    return found


def test_all_templates_of_a_leaf_are_met(spark, monkeypatch):
    """Against comparing every line with every template, of few words and of many."""
    rng, rare, recurring = random.Random(4), set(), {}
    for n, n_words in ((5, 12), (8, 3), (12, 2), (12, 4), (12, 40), (30, 2)):
        head, keepers = f"h{n} h{n_words} h", list(range(150))
        base = [[f"w{p}x{k}" for k in range(n_words)] for p in range(n - 3)]
        rng.shuffle(keepers)
        for keeper in keepers:
            recurring[" ".join([head, *map(rng.choice, base)])] = (n * 100 + n_words, keeper // 2)
        for template in rng.sample([t for t in recurring if t.startswith(head + " ")], 60):
            tokens = template.split()
            for _ in range(rng.randint(0, n // 5 + 1)):
                place = rng.randrange(3, n)
                tokens[place] = rng.choice([*base[place - 3], "new"])
            rare.add((n * 100 + n_words, " ".join(tokens)))
    recurring = [(leaf, text, keeper) for text, (leaf, keeper) in recurring.items()]
    lines = spark.createDataFrame(sorted(rare), "leaf bigint, line string").selectExpr(
        "*", "xxhash64(line) AS line_hash", "xxhash64(7, line) AS line_check"
    )
    templates = spark.createDataFrame(recurring, "leaf bigint, template string, keeper bigint")
    expected = near_by_hand(rare, recurring)
    for crowd in (0, line_dedup.CROWD, 10**9):
        monkeypatch.setattr(line_dedup, "CROWD", crowd)
        near = line_dedup._near(lines, templates).groupBy("line_hash").agg({"keeper": "min"})
        rows = near.join(lines, "line_hash").select("line", "min(keeper)").collect()
        assert {r[0]: r[1] for r in rows} == expected
    assert 200 < len(expected) < len(rare)
