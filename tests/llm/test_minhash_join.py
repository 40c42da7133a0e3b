import random
import re
from collections import Counter, defaultdict
from math import comb

import numpy as np
import pytest

from basket_marts.llm import minhash_join
from basket_marts.llm.minhash_join import COORDINATES, MATCHES, Family, minhash_components, signatures
from basket_marts.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string"


def shingles(text):
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(rows):
    """(doc_id, n_shingles, component_id, kept) by counting every pair that shares a shingle."""
    sets = [shingles(text) for _, text in rows]
    holders, group = defaultdict(list), list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for x, own in enumerate(sets):
        overlaps = Counter(y for s in own for y in holders[s])
        for y, n in overlaps.items():
            if 100 * n >= 85 * (len(own) + len(sets[y]) - n):
                group[top(x)] = top(y)
        for s in own:
            holders[s].append(x)
    least = {}
    for x, (doc_id, _) in enumerate(rows):
        if doc_id is not None and sets[x]:
            least[top(x)] = min(least.get(top(x), doc_id), doc_id)
    found = [(i, len(s), least.get(top(x), i) if s else i) for x, ((i, _), s) in enumerate(zip(rows, sets))]
    return [(*row, row[0] == row[2]) for row in found]


def compared(frame):
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    found = minhash_components(frame).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute_force(rows)))


def family(rng, size, length, most_edits):
    base = [f"{rng.randrange(4000):x}" for _ in range(length)]
    for _ in range(size):
        words = list(base)
        for at in rng.sample(range(length), rng.randint(0, most_edits)):
            words[at] = f"{rng.randrange(4000):x}"
        yield " ".join(words)


@pytest.fixture(scope="module")
def mixed():
    """Families tight and loose, chains, a passage in many texts, exact and short texts."""
    rng, texts = random.Random(4), []
    for size, length, edits in [(60, 150, 2), (50, 120, 4), (5, 200, 5), (2, 12, 1), (30, 60, 1), (40, 200, 8)]:
        texts += family(rng, size, length, edits)
    chain = [f"{i:x}" for i in range(400)]
    texts += [" ".join(chain[i * 6 : i * 6 + 120]) for i in range(40)]
    passage = " ".join(f"p{i}" for i in range(60))
    for _ in range(80):
        own = " ".join(f"{rng.randrange(9000):x}" for _ in range(rng.randint(0, 60)))
        texts.append(f"{own} {passage}")
    texts += ["a b c", "A  b c", "a b", "", " \n", "five words are just enough", "five words are just enough "]
    texts += [texts[0]] * 30 + [None, None]
    rng.shuffle(texts)
    return [(3 * i + 1, text) for i, text in enumerate(texts)]


def test_mixed(spark, mixed):
    compared(spark.createDataFrame(mixed, SCHEMA))


@pytest.mark.parametrize("hubs", [1, 4])
def test_families_over_several_tasks(spark, mixed, monkeypatch, hubs):
    """Cut into parts of a few sets, connected through few hubs, most families stay open."""
    monkeypatch.setattr(minhash_join, "FAMILY_SHINGLES", 400)
    monkeypatch.setattr(minhash_join, "HUBS", hubs)
    monkeypatch.setattr(minhash_join, "SLICE_BYTES", 3000)
    compared(spark.createDataFrame(mixed, SCHEMA).repartition(3))


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = QUERIES["op12_minhash_join"](spark, small).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute_force(rows)))
    assert len({r.component_id for r in found}) < len(rows)


def test_odd_rows(odd):
    compared(odd)


def test_repeated_ids_and_rows(spark):
    text = "one two three four five six seven eight"
    rows = [(5, text)] * 40 + [(5, text + " "), (None, text), (7, text), (None, "alone here"), (9, None), (9, None)]
    compared(spark.createDataFrame(rows, SCHEMA).repartition(3))


def test_no_rows(no_rows):
    found = minhash_components(no_rows)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"] and found.collect() == []


def test_the_threshold_loses_one_link_in_a_billion():
    lost = sum(comb(COORDINATES, i) * 0.85**i * 0.15 ** (COORDINATES - i) for i in range(MATCHES))
    assert lost < 1e-9


def test_coordinates_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(5)
    pairs, agreed, alike = 60, 0, 0
    for _ in range(pairs):
        both = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        a, b = (np.unique(np.append(both, rng.integers(0, 1 << 63, 30, dtype=np.uint64))) for _ in "ab")
        x, y = signatures([a, b])
        agreed += (x == y).mean() / pairs
        alike += len(np.intersect1d(a, b)) / len(np.union1d(a, b)) / pairs
    assert abs(agreed - alike) < 0.03


@pytest.mark.parametrize("seed", range(5))
def test_roots_of_random_sets(seed):
    """Also from partly known groups, and with only the sets outside the largest one asking."""
    rng = np.random.default_rng(seed)
    bases = [rng.integers(0, 1 << 60, 40, dtype=np.uint64) for _ in range(6)]
    sets = []
    for _ in range(80):
        base = bases[rng.integers(6)].copy()
        base[rng.integers(0, 40, rng.integers(0, 5))] = rng.integers(0, 1 << 60)
        sets.append(np.unique(base))
    n, group = len(sets), np.arange(80)
    for x in range(n):
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= 85 * (len(sets[x]) + len(sets[y]) - both):
                group[group == group[x]] = group[y]

    def shape(labels):
        return {frozenset(np.flatnonzero(labels == g).tolist()) for g in set(labels.tolist())}

    held = Family(sets, signatures(sets))
    assert shape(held.roots(np.arange(n), np.ones(n, dtype=bool))) == shape(group)
    largest = np.bincount(group).argmax()
    known = np.where(group == largest, np.flatnonzero(group == largest)[0], np.arange(n))
    assert shape(held.roots(known, group != largest)) == shape(group)
