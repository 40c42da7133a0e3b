import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from basket_marts.llm import ngram_join
from basket_marts.llm.components import connected_components
from basket_marts.llm.ngram_join import first_of_each, linked_roots, ngram_components
from basket_marts.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string"


def shingles(text):
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(rows):
    """(doc_id, n_shingles, component_id) by counting every pair that shares a shingle."""
    sets = [shingles(text) for _, text in rows]
    holders, group = defaultdict(list), list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for x, own in enumerate(sets):
        overlaps = Counter(y for s in own for y in holders[s])
        for y, n in overlaps.items():
            if 100 * n >= 75 * (len(own) + len(sets[y]) - n):
                group[top(x)] = top(y)
        for s in own:
            holders[s].append(x)
    least = {}
    for x, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(x)] = min(least.get(top(x), doc_id), doc_id)
    return [(i, len(s), least.get(top(x))) for x, ((i, _), s) in enumerate(zip(rows, sets))]


def spread(rows):
    return sorted(rows, key=str)


def family(rng, size, length, most_edits):
    base = [f"{rng.randrange(4000):x}" for _ in range(length)]
    for _ in range(size):
        words = list(base)
        for at in rng.sample(range(length), rng.randint(0, most_edits)):
            words[at] = f"{rng.randrange(4000):x}"
        yield " ".join(words)


@pytest.fixture(scope="module")
def mixed():
    """Families tight and loose, a passage and lines in many texts, exact and short texts."""
    rng, texts = random.Random(4), []
    for size, length, edits in [(40, 100, 3), (60, 80, 6), (5, 200, 5), (2, 12, 1), (30, 60, 4)]:
        texts += family(rng, size, length, edits)
    passage = " ".join(f"p{i}" for i in range(30))
    for _ in range(80):
        own = " ".join(f"{rng.randrange(9000):x}" for _ in range(rng.randint(3, 60)))
        texts.append(f"{own} {passage}")
    texts += ["a b c", "A  b c", "a b", "", " \n", "five words are just enough", "five words are just enough "]
    texts += [texts[0]] * 30 + [None, None]
    rng.shuffle(texts)
    return [(3 * i + 1, text) for i, text in enumerate(texts)]


def test_mixed(spark, mixed):
    found = ngram_components(spark.createDataFrame(mixed, SCHEMA)).collect()
    assert spread(map(tuple, found)) == spread(brute_force(mixed))


def test_small_bounds_change_nothing(spark, mixed, monkeypatch):
    """Chunks of few texts, common shingles and families over several tasks."""
    monkeypatch.setattr(ngram_join, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(ngram_join, "COMMON", 3)
    monkeypatch.setattr(ngram_join, "FAMILY_SHINGLES", 400)
    monkeypatch.setattr(ngram_join, "FRAGMENT_SHINGLES", 300)
    frame = spark.createDataFrame(mixed, SCHEMA).repartition(5)
    assert spread(map(tuple, ngram_components(frame).collect())) == spread(brute_force(mixed))


def test_query(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = QUERIES["op7_ngram_join"](spark, small).collect()
    assert spread(map(tuple, found)) == spread(brute_force(docs))


def test_one_of_each_group_stays(spark, mixed):
    kept = first_of_each(spark.createDataFrame(mixed, SCHEMA)).collect()
    expected = [i for i, n, c in brute_force(mixed) if n == 0 or i == c]
    assert sorted(r.doc_id for r in kept) == sorted(expected)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    expected = [(i, n, i if n == 0 else c) for i, n, c in brute_force(rows)]
    assert spread(map(tuple, ngram_components(odd).collect())) == spread(expected)
    kept = first_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted(r.doc_id or 0 for r in kept.collect())
    assert ids == [0, 0, 1, 2, 3, 4, 5, 7, 8, 9]


def test_repeated_ids_and_rows(spark):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (5, text + " "), (None, text), (7, text)]
    kept = first_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(kept) == 1 and kept[0].doc_id == 5


def test_no_rows(no_rows):
    assert ngram_components(no_rows).collect() == []
    assert first_of_each(no_rows).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_roots_of_random_sets(seed):
    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.integers(0, 30, rng.integers(8, 25))).astype("<u8") for _ in range(60)]
    sizes = np.array([len(s) + (i % 3) for i, s in enumerate(sets)])
    group = list(range(60))
    for x in range(60):
        for y in range(x):
            n = len(np.intersect1d(sets[x], sets[y]))
            if 100 * n >= 75 * (sizes[x] + sizes[y] - n):
                old, new = max(group[x], group[y]), min(group[x], group[y])
                group = [new if g == old else g for g in group]
    assert linked_roots(sets, sizes).tolist() == group


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.component for r in connected_components(frame).collect()}
    assert found == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 160)}
