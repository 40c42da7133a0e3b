import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from basket_marts.llm import prefix_trie
from basket_marts.llm.prefix_trie import DoubleArray, member_digests, node_summary, packed

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_force(rows):
    """Nodes as a dictionary of prefixes; equal turn numbers must belong to equal turns."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(own[c])] for c in own}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        path = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    for node in members:
        digest = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        above = members[node[:-1]][0] if node else None
        yield (members[node][0], len(node), above, len(members[node]), len(children[node]), leaves[node], saved[node], digest)


def compared(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = sorted(map(str, map(tuple, node_summary(frame).select(*COLUMNS).collect())))
    assert found == sorted(map(str, brute_force(rows)))


def conversations(seed, n, words, turns):
    rng = random.Random(seed)
    for c in rng.sample(range(n * 3), n):
        for turn in range(rng.randint(0, turns)):
            yield c, turn, rng.choice(["user", "assistant", None]), rng.choice(words)


WORDS = ["hi", "yes", "", "né漢😀", "no", None]


@pytest.mark.parametrize("seed", range(3))
def test_bushy(spark, seed):
    compared(spark, list(conversations(seed, 250, WORDS, 7)))


def test_common_turns_copies_and_long_ones(spark):
    rng, rows = random.Random(8), []
    same = [(t, "user", f"t{t}") for t in range(12)]
    for c in range(0, 300):
        # One conversation in a third of all ids, one first turn in the next third.
        turns = same if c % 3 == 0 else same[:1] if c % 3 == 1 else []
        turns = [*turns, *((t + 20, "user", rng.choice(WORDS)) for t in range(rng.randint(0, 4) * (c % 3 > 0)))]
        rows += [(c, *turn) for turn in turns]
    long = [(t, "user", "abc" * (t % 5)) for t in range(900)]
    rows += [(1000, *turn) for turn in long] + [(1100, *turn) for turn in long]
    rows += [(1200, *turn) for turn in [*long[:700], (700, "user", "other")]]
    rows += [(1300, *turn) for turn in long[:40]]
    rng.shuffle(rows)
    compared(spark, rows)


def test_nulls_ties_repeats_negative_ids(spark):
    rows = [
        (5, 1, "user", "a"), (5, 1, "user", "a"), (5, None, None, None), (5, 3, "user", "b"),
        (None, 1, "user", "lost"), (None, None, None, None), (0, 2, None, "x"), (0, 1, "user", "a"),
        (-105, 1, "user", "a"), (-100, 1, "user", "a"), (7, None, "user", None), (200, 0, "", ""),
    ]
    compared(spark, rows + [(c, t, "u", "z") for c in range(300, 340) for t in range(c % 7)])


def test_small_shards_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 9)
    compared(spark, list(conversations(4, 120, WORDS[:3], 9)))


def test_all_turns_lent_or_none_left(spark):
    compared(spark, [(c, 0, "user", "only") for c in range(1, 40)])


def test_no_rows_and_extra_columns(spark):
    assert node_summary(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = list(conversations(1, 30, WORDS, 4))
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "depth", "path", "shard", "part", "position", "length", "h", "b"):
        frame = frame.withColumn(name, F.lit("x"))
    found = node_summary(frame)
    assert sorted(found.columns) == sorted(COLUMNS)
    assert sorted(map(str, map(tuple, found.select(*COLUMNS).collect()))) == sorted(map(str, brute_force(rows)))


def test_digests_of_many_members(spark):
    ids = random.Random(2).sample(range(-50_000, 200_000), 45_000)
    rows = [(1, i) for i in ids] + [(2, 7), (3, 9), (3, 10), (3, -1)]
    found = {r.end_path: r.ends_sha256 for r in member_digests(spark.createDataFrame(rows, "path bigint, conv_id bigint")).collect()}
    for path in (1, 2, 3):
        joined = ",".join(map(str, sorted(i for p, i in rows if p == path)))
        assert found[path] == hashlib.sha256(joined.encode()).hexdigest()


@pytest.mark.parametrize("seed", range(4))
def test_double_arrays_hold_every_sequence(seed):
    rng = np.random.default_rng(seed)
    lengths = -np.sort(-rng.integers(1, 30, 400))
    starts = np.append(0, np.cumsum(lengths)[:-1])
    codes = rng.integers(0, [3, 40, 500, 5000][seed], lengths.sum())
    trie, states = packed(codes, starts, lengths)
    prefixes = {}
    for start, length in zip(starts.tolist(), lengths.tolist()):
        at = np.zeros(1, dtype=np.int64)
        for d in range(length):
            at = trie.step(at, codes[start + d : start + d + 1])
            assert at[0] == states[start + d]
            prefixes.setdefault(tuple(codes[start : start + d + 1].tolist()), int(at[0]))
            assert prefixes[tuple(codes[start : start + d + 1].tolist())] == at[0]
    assert len(set(prefixes.values())) == len(prefixes) == (trie.check >= 0).sum()
    with pytest.raises(KeyError):
        trie.step(np.zeros(1, dtype=np.int64), np.array([9999]))


def test_children_far_apart_fit_between_others():
    trie = DoubleArray()
    for state, codes in enumerate([[0, 3000], [1, 2, 2500], [7], [0, 3000], [0, 1, 2, 3]]):
        trie.place(1000 + state, np.array(codes))
    assert (trie.check >= 0).sum() == 12
