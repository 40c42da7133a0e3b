import random
import tracemalloc

from basket_marts.llm.queries import QUERIES
from basket_marts.llm.quotes import (
    in_reply_order,
    linked_conversations,
    passage_hashes,
    passages,
    quote_levels,
)

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
THREAD = [
    (1, 0, "user", "How do I pack boxes?\n\nAnd where do they go?"),
    (1, 1, "assistant", "On Monday user wrote:\n> How do I  PACK boxes?\nTightly."),
    (1, 2, "user", "> And where do they go?\n\nStill asking."),
    (1, 3, "user", "> > How do I pack boxes?\n> Tightly.\nThanks!"),
    (1, 4, "user", "> nobody said this\nHm."),
    (1, 5, "user", ">> How do I pack boxes?\nOld story."),
    (1, 6, "user", "> Thanks!\n> Still asking.\n> Hm.\nAll of you."),
    (2, 0, "user", "> Tightly.\nAnother conversation."),
    (2, 1, "user", "quoted later\n> quoted before it is said"),
    (2, 2, "user", "quoted before it is said"),
]


def test_levels_and_attributions():
    text = "Hello\r\nOn 3 May, A. wrote:\r\n> one\r\n>> two\n > three\nend > here"
    assert quote_levels(text) == [
        (0, "Hello"), (1, "one"), (2, "two"), (1, "three"), (0, "end > here"),
    ]


def test_passages_are_runs_paragraphs_and_lines():
    lines = [(1, "Some  Words"), (1, "more"), (1, ""), (1, "Next"), (0, ""), (0, "own")]
    assert passages(lines) == {
        (1, "some words more next"), (1, "some words more"), (1, "next"),
        (1, "some words"), (1, "more"), (0, "own"),
    }


def test_replies_are_linked(spark):
    rows = linked_conversations(spark.createDataFrame(THREAD, SCHEMA)).collect()
    links = {(r.conv_id, r.turn): r.reply_to for r in rows}
    assert links == {
        (1, 0): None, (1, 1): 0, (1, 2): 0, (1, 3): 1, (1, 4): None, (1, 5): 0,
        (1, 6): 4, (2, 0): None, (2, 1): None, (2, 2): None,
    }
    paths = {(r.conv_id, r.turn): r.reply_path for r in rows}
    assert paths[1, 3] == [0, 1, 3] and paths[1, 6] == [4, 6] and paths[2, 0] == [0]
    bodies = {(r.conv_id, r.turn): r.body for r in rows}
    assert bodies[1, 1] == "Tightly." and bodies[1, 3] == "Thanks!"
    ordered = in_reply_order(linked_conversations(spark.createDataFrame(THREAD[:7], SCHEMA)))
    assert [r.turn for r in ordered.collect()] == [0, 1, 3, 2, 5, 4, 6]


def test_long_chain(spark):
    chain = [(7, 0, "u", "line 0")] + [
        (7, i, "u", f"> line {i - 1}\nline {i}") for i in range(1, 40)
    ]
    rows = linked_conversations(spark.createDataFrame(chain, SCHEMA)).collect()
    assert {r.turn: r.reply_path for r in rows} == {i: list(range(i + 1)) for i in range(40)}


def test_odd_rows(spark):
    rows = [
        (None, 0, "u", "text"), (None, 1, "u", "> text"), (1, None, "u", "text"),
        (1, 0, None, None), (1, 1, "u", ""), (1, 2, "u", ">"), (1, 3, "u", "said"),
        (1, 3, "u", "said"), (1, 4, "u", "> said\nx"), (1, 4, "u", "> said\ny"),
        (1, 5, "u", "> " * 500 + "deep"), (1, 6, "u", "w " * 50_000),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS passages", "2 AS body")
    found = linked_conversations(frame).collect()
    assert len(found) == len(rows)
    assert sorted(r.body for r in found if r.turn == 4) == ["x", "y"]
    assert {r.reply_to for r in found if r.turn == 4} == {3}
    assert all(r.reply_to is None for r in found if r.conv_id is None or r.turn is None)


def test_no_rows(spark):
    assert linked_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_keeps_every_message(spark, small):
    messages = spark.read.parquet(f"{small}/conversations.parquet")
    rows = QUERIES["op5_quotes"](spark, small).collect()
    assert len(rows) == messages.count()
    by_turn = {(r.conv_id, r.turn): r for r in messages.collect()}
    for row in rows:  # no message of these quotes
        assert row.reply_to is None and row.body == by_turn[row.conv_id, row.turn].text.strip()


def test_sentences_quoted_from_the_middle_of_a_line(spark):
    line = "First a word. Boxes are packed tightly! Then they are closed. They go by train. The end."
    rows = [
        (1, 0, "user", "They go by train. Or so I heard."),
        (1, 1, "assistant", line),
        (1, 2, "user", "> Boxes are packed tightly!\nReally?"),
        (1, 3, "user", "> Boxes are packed tightly! Then\n> they are closed.\nBoth."),
        (1, 4, "user", "> Then they are closed. They go by train.\nWhen?"),
        (1, 5, "user", "> Boxes are not packed.\nWho says so?"),
    ]
    found = linked_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.turn: r.reply_to for r in found} == {0: None, 1: None, 2: 1, 3: 1, 4: 1, 5: None}


def test_hashes_tell_sequences_of_sentences():
    text = [f"sentence {i}." for i in range(13)]
    own = passage_hashes(" ".join(text))
    assert len(own) == 13 + 12 + 10 + 6 + 1
    for first in range(13):
        for last in range(first + 1, 14):
            part = passage_hashes(" ".join(text[first:last]))
            # All runs of a part are runs of the whole, but for the part itself if it is of
            # another length than 1, 2, 4, ...
            assert len(part - own) <= (last - first not in (1, 2, 4, 8, 13))
    assert not passage_hashes("sentence 2. sentence 1.") <= own
    assert passage_hashes("") == set()


def test_many_sentences_take_little_memory():
    text = " ".join(f"this is the sentence of number {i} and no other." for i in range(20_000))
    tracemalloc.start()
    found = passage_hashes(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) > 900_000 and len(found) > 200_000 and peak < 150 << 20


def brute_force(messages):
    """Links by comparing every quoted passage, part by part, with all earlier messages."""
    hashes = {}
    for turn, text in messages:
        for level, unit in passages(quote_levels(text)):
            hashes.setdefault(turn, set()).update((level, h) for h in passage_hashes(unit))
    links = {}
    for turn, _ in messages:
        votes = {}
        for level, unit in hashes.get(turn, ()):
            if level:
                holders = [t for t, _ in messages if (0, unit) in hashes.get(t, ())]
                if holders and min(holders) < turn:
                    votes.setdefault(level, []).append(min(holders))
        best = votes[min(votes)] if votes else []
        links[turn] = max(best, key=lambda t: (best.count(t), t)) if best else None
    return links


def test_random_threads_against_brute_force(spark):
    rng = random.Random(6)
    for conv in range(3):
        messages = []
        for turn in range(25):
            own = " ".join(f"{rng.choice('abcdef')} says {rng.randint(0, 30)}." for _ in range(rng.randint(1, 6)))
            quoted = []
            for _, text in rng.sample(messages, min(len(messages), rng.randint(0, 2))):
                sentences = text.splitlines()[-1].split(". ")
                first = rng.randrange(len(sentences))
                quoted.append("> " * rng.randint(1, 2) + ". ".join(sentences[first : first + rng.randint(1, 4)]))
            messages.append((turn, "\n".join([*quoted, own])))
        frame = spark.createDataFrame([(conv, t, "u", text) for t, text in messages], SCHEMA)
        found = {r.turn: r.reply_to for r in linked_conversations(frame).collect()}
        assert found == brute_force(messages) and any(v is not None for v in found.values())
