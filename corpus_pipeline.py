"""From documents to packed token sequences: five stages, each an operator of the library.

    python corpus_pipeline.py <tables> <output>
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basket_marts.llm import decontaminate, line_dedup, ngram_join, packing, quality
from basket_marts.llm.common import (
    code_points,
    documents,
    keep_last_stored,
    scratch_mark,
    stored,
    vocabulary_path,
)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; the others go."""
    return quality.good_texts(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines whose template recurs; `n_chars` counts what is left."""
    deduplicated = line_dedup.drop_recurring_lines(docs).select(*docs.columns)
    return deduplicated.withColumn("n_chars", code_points(F.col("text")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares its shingles."""
    return ngram_join.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of token ids."""
    return packing.packed_sequences(docs, vocabulary_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("line_dedup", without_recurring_lines),
    ("ngram_join", without_near_copies),
    ("decontaminate", without_benchmark),
    ("packing", packed),
]

# Fitting a model and packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each reads what the one before it has written, which is then
    removed with what the stage stored on the way.
    """
    docs, mark = documents(spark, sf_dir), scratch_mark()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        keep_last_stored(spark, mark)
    return docs


if __name__ == "__main__":
    session = SparkSession.builder.appName("corpus-pipeline").getOrCreate()
    run(session, sys.argv[1]).write.parquet(sys.argv[2])
