import zlib

import numpy as np
import pyarrow as pa
import pytest

from basket_marts.llm import quality
from basket_marts.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def result(spark):
    return {r.doc_id: r for r in QUERIES["op3_quality"](spark, FOLDER).collect()}


def test_held_out_accuracy(spark, result):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    held_out = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = [result[r.doc_id].predicted == r.quality for r in held_out]
    assert len(right) > 50 and np.mean(right) > 0.95
    good = [result[r.doc_id].predicted for r in held_out if r.quality == 1]
    assert np.mean(good) > 0.97


def test_every_document_is_scored(spark, result):
    ids = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert set(result) == ids
    for row in result.values():
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)


def test_labels_of_held_out_rows_change_nothing(spark, result):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").selectExpr(
        "doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 1 - quality, quality) AS quality"
    )
    flipped = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert flipped == {i: r.score for i, r in result.items()}


def test_features_depend_on_each_text_alone():
    texts = ["a text", "", None, "Another: one!\nand a line", "é" * 50]
    together = quality.batch_features(pa.array(texts))
    alone = np.stack([quality.batch_features(pa.array([t], pa.string()))[0] for t in texts])
    assert (together == alone).all() and not together[1].any() and not together[2].any()


def test_non_negative_risk_separates_mixtures():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (900, 5)), rng.normal(-1, 1, (300, 5))
    positives = rng.normal(1, 1, (400, 5)).astype(np.float32)
    unlabelled = np.concatenate([good, bad]).astype(np.float32)
    weights, bias = quality.fit_nnpu(positives, unlabelled, prior=0.75)
    score = unlabelled @ weights + bias
    assert (score[:900] > 0).mean() > 0.9 and (score[900:] < 0).mean() > 0.9


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame(
        [(1, 1), (5, 0), (None, 1), (6, None), (6, 1), (99, 1)], "doc_id bigint, quality int"
    )
    rows = quality.quality_scores(odd, labels).collect()
    assert len(rows) == odd.count()
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    kept = quality.good_texts(odd, labels)
    assert kept.columns == odd.columns and set(kept.collect()) <= set(odd.collect())


def test_nothing_to_learn_from(spark, odd, no_rows):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.quality_scores(odd, none).collect()} == {0.5}
    assert quality.quality_scores(no_rows, none).collect() == []
