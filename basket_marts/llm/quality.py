"""Text quality by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are texts labelled good, the unlabelled are texts of the corpus as they
come. With class prior p, risk on the negatives is estimated as R_u - p R_p (loss of calling
texts negative, over the unlabelled and over the positives). A flexible model drives that
difference below zero; the non-negative estimator then steps back instead.

Features are computed by Spark tasks. The model is fitted on a bounded sample (parameters
below); the class prior and every score cover all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basket_marts.llm.common import forget_remembered, pack_rest, text_slices, unpack_rest
from basket_marts.llm.shingles import word_hashes

# Bounds of the fitting sample: about so many rows of each kind.
MAX_POSITIVES = 6_000
MAX_UNLABELLED = 12_000
SEED = 11
HASHED = 1024
DENSE = 12

_SLICE_BYTES = 1 << 20


# Features -----------------------------------------------------------------------------


def _byte_classes() -> np.ndarray:
    """Space, line feed, digit, lower case, upper case, other ASCII, beyond ASCII."""
    classes = np.full(256, 5)
    classes[[9, 11, 12, 13, 32]] = 0
    classes[10] = 1
    classes[ord("0") : ord("9") + 1] = 2
    classes[ord("a") : ord("z") + 1] = 3
    classes[ord("A") : ord("Z") + 1] = 4
    classes[128:] = 6
    return classes


_CLASS = _byte_classes()


def batch_features(texts: pa.Array) -> np.ndarray:
    """One row of features per text: shares of byte classes, density and repetition of
    words, and hashed byte trigrams as square roots of their shares. A NULL or empty text
    has zeros.
    """
    texts = texts.fill_null("").cast(pa.large_binary())
    found = np.zeros((len(texts), DENSE + HASHED), dtype=np.float32)
    ends = np.cumsum(pa.compute.binary_length(texts).to_numpy()).astype(np.int64)
    joined = np.frombuffer(b"".join(texts.to_pylist()), dtype=np.uint8)
    words, n_words = word_hashes(joined, ends)
    start, first_word = 0, 0
    for row, end, count in zip(found, ends.tolist(), n_words.tolist()):
        if end > start:
            data = joined[start:end]
            row[:7] = np.bincount(_CLASS[data], minlength=7) / len(data)
            letters = row[3] + row[4]
            row[7] = row[4] / letters if letters else 0
            row[8] = np.log1p(len(data)) / 16
            if count:
                own = words[first_word : first_word + count]
                row[9] = count / len(data)
                row[10] = len(np.unique(own)) / count
                pairs = own[:-1] * np.uint64(3) + own[1:]
                row[11] = len(np.unique(pairs)) / max(1, count - 1)
            if len(data) > 2:
                row[DENSE:] = np.sqrt(_trigram_shares(data))
        start, first_word = end, first_word + count
    return found


def _trigram_shares(data: np.ndarray) -> np.ndarray:
    d = data.astype(np.uint32)
    grams = d[:-2] * np.uint32(0x9E3779B1) ^ d[1:-1] * np.uint32(0x85EBCA77)
    grams = (grams ^ d[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    slots = (grams >> np.uint32(16)) % np.uint32(HASHED)
    return np.bincount(slots, minlength=HASHED) / len(slots)


# Model --------------------------------------------------------------------------------


def fit_nnpu(
    positives: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    steps: int = 400,
    batch: int = 256,
    rate: float = 0.01,
    decay: float = 5e-2,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic score that minimise the non-negative PU risk.

    Stochastic steps over paired batches (Adam). Where the estimated risk on negatives is
    below zero in a batch, the step ascends that part instead of descending the whole.
    """
    rng = np.random.default_rng(SEED)
    width = positives.shape[1]
    weights = np.zeros(width + 1)
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p_all = _standardised(positives, mean, scale)
    u_all = _standardised(unlabelled, mean, scale)
    for step in range(1, steps + 1):
        u = u_all[rng.integers(0, len(u_all), batch)]
        p = p_all[rng.integers(0, len(p_all), batch)]
        # Logistic losses: -log s(z) for positive, -log(1 - s(z)) for negative.
        p_score, u_score = _sigmoid(p @ weights), _sigmoid(u @ weights)
        negative_risk = prior * np.log1p(-np.minimum(p_score, 1 - 1e-9)).mean()
        negative_risk -= np.log1p(-np.minimum(u_score, 1 - 1e-9)).mean()
        negative = u.T @ u_score / batch - prior * (p.T @ p_score) / batch
        if negative_risk >= 0:
            gradient = negative - prior * (p.T @ (1 - p_score)) / batch
        else:
            gradient = -negative
        gradient[:-1] += decay * weights[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        size = rate * (1 - step / (steps + 1))
        first_now, second_now = first / (1 - 0.9**step), second / (1 - 0.999**step)
        weights -= size * first_now / (np.sqrt(second_now) + 1e-8)
    plain = weights[:-1] / scale
    return plain, float(weights[-1] - mean @ plain)


def _standardised(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.hstack([(rows - mean) / scale, np.ones((len(rows), 1), dtype=np.float32)])


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


# Spark --------------------------------------------------------------------------------


def _features_of(rows: DataFrame) -> np.ndarray:
    """Features of a bounded frame of texts, brought to the driver as 16-bit floats."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, size=_SLICE_BYTES):
            found = batch_features(batch.column("text")).astype(np.float16)
            packed = pa.array([row.tobytes() for row in found], type=pa.binary())
            yield pa.RecordBatch.from_arrays([packed], names=["features"])

    packed = rows.select("text").mapInArrow(describe, "features binary").toArrow()
    data = b"".join(packed.column("features").to_pylist())
    return np.frombuffer(data, dtype=np.float16).reshape(-1, DENSE + HASHED).astype(np.float32)


def is_held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 3, is 1. False for a NULL id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """About `most` rows where there are more, by a hash of their ids: re-runs agree."""
    count = rows.count()
    if count <= most:
        return rows
    lot = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 40))
    return rows.where(lot < int((1 << 40) * most / count))


def train(texts: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Fit on rows that are not held out.

    `texts` (doc_id, text), `labels` (doc_id, quality). Labels of NULL ids or NULL quality
    tell nothing; an id labelled twice counts as good if any label says so. The prior is the
    share of good among the labelled; no text is left out of it.
    Without positives or without other texts there is nothing to fit: every score is 0.5.
    """
    learned = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(~is_held_out())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
    )
    counts = learned.agg(
        F.count(F.lit(1)).alias("labelled"), F.sum(F.col("quality").cast("bigint")).alias("good")
    ).first()
    if not counts["labelled"] or not counts["good"]:
        return np.zeros(DENSE + HASHED), 0.0
    prior = min(counts["good"] / counts["labelled"], 0.99)
    texts = texts.select("doc_id", "text").where(~is_held_out())
    good = _sample(learned.where("quality = 1").select("doc_id"), MAX_POSITIVES)
    # The sample's size is bounded, so it may be broadcast.
    positives = _features_of(texts.join(F.broadcast(good), "doc_id", "left_semi"))
    unlabelled = _features_of(_sample(texts, MAX_UNLABELLED))
    if not len(positives) or not len(unlabelled):
        return np.zeros(DENSE + HASHED), 0.0
    return fit_nnpu(positives, unlabelled, prior)


def scores(texts: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """All columns of `texts` with `score` (0 to 1) and `predicted` added or replaced; of the
    input only `text` is looked at.
    """
    weights, bias = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_remembered()
        for batch in text_slices(batches, size=_SLICE_BYTES):
            found = _sigmoid(batch_features(batch.column("text")) @ weights + bias)
            columns = [*batch.columns, pa.array(found, type=pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "score"])

    packed = pack_rest(texts)
    schema = T.StructType([*packed.schema.fields, T.StructField("score", T.DoubleType())])
    predicted = (F.col("score") >= 0.5).cast("int")
    scored = packed.mapInArrow(score, schema)
    return unpack_rest(scored, texts.columns, score=F.col("score"), predicted=predicted)


def good_texts(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `texts`, all columns, that are predicted good."""
    scored = scores(pack_rest(texts), train(texts, labels))
    return unpack_rest(scored.where("predicted = 1"), texts.columns)


def quality_scores(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of `texts`: doc_id, held_out, score, predicted.

    NULL and empty texts get the score of no features. Repeated rows are scored each; an
    empty table gives no rows. Nothing but the text is an input of a score.
    """
    scored = scores(texts.select("doc_id", "text"), train(texts, labels))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
