import hashlib
import random
import re

import pytest

from basket_marts.llm import iblt
from basket_marts.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string"


def paragraphs(text):
    found = {p for p in re.sub(r"(?<=[.!?]) (?![M-Zm-z])", "\n", text).split("\n")}
    return {p for p in found if p.strip(" ")}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_force(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        sha256 = hashlib.sha256(edited.encode()).hexdigest()
        yield (doc_id, len(text), sha256, likeness(text, edited), likeness(text, after))


def compare(result, rows):
    found = result.select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next").collect()
    by_key = lambda r: str(tuple(r)[:3])
    expected = sorted(brute_force(rows), key=by_key)
    for row, other in zip(sorted(found, key=by_key), expected, strict=True):
        assert tuple(row)[:3] == other[:3] and tuple(row)[3:] == pytest.approx(other[3:])


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    result = QUERIES["op4_fingerprints"](spark, small).cache()
    compare(result, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    rows = result.collect()
    result.unpersist()
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {}
    for row in rows:
        assert prints.setdefault(texts[row.doc_id], row.fingerprint) == row.fingerprint
    different = {frozenset(paragraphs(t)) for t in texts.values()}
    assert len(set(prints.values())) == len(different)


def test_odd_rows(odd):
    compare(iblt.fingerprint_versions(odd), [(r.doc_id, r.text) for r in odd.collect()])


def test_gaps_between_ids_and_a_single_row(spark):
    rows = [(i, f"text {i}. Another. Zzz\nline {i % 3}") for i in (-5000, 3, 5, 2048, 9_000_000_000)]
    compare(iblt.fingerprint_versions(spark.createDataFrame(rows, SCHEMA)), rows)
    compare(iblt.fingerprint_versions(spark.createDataFrame(rows[:1], SCHEMA)), rows[:1])


def test_no_rows(no_rows):
    assert iblt.fingerprint_versions(no_rows).collect() == []


def test_differences_of_all_sizes(spark):
    """From none to far more than a fingerprint holds, so that sketches grow."""
    rng, rows, expected = random.Random(1), [], {}
    for pair, (both, left, right) in enumerate(
        [(10, 0, 0), (10, 1, 0), (0, 0, 3), (500, 9, 9), (40, 60, 3), (0, 700, 900), (3000, 1, 1)]
    ):
        digests = [x - (1 << 61) for x in rng.sample(range(1 << 62), both + left + right)]
        rows.append((pair, digests[: both + left], digests[:both] + digests[both + left :]))
        if left or right:
            expected[pair] = (left, right)
    frame = spark.createDataFrame(rows, "pair bigint, left array<bigint>, right array<bigint>")
    found = {r.pair: (r.only_left, r.only_right) for r in iblt.differences(frame).collect()}
    assert found == expected


def test_locked_sketches_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(iblt, "MAX_RETRIES", 1)
    frame = spark.createDataFrame(
        [(1, list(range(500)), [0])], "pair bigint, left array<bigint>, right array<bigint>"
    )
    with pytest.raises(RuntimeError):
        iblt.differences(frame)
