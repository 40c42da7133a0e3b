"""The numbered operators applied to their whole tables: `QUERIES[name](spark, folder)`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basket_marts.llm import (
    decontaminate,
    iblt,
    infill,
    licenses,
    line_dedup,
    minhash_join,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    quotes,
    token_counts,
    warc,
)
from basket_marts.llm.common import documents, vocabulary_path
from basket_marts.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _query(define: Query) -> Query:
    QUERIES[define.__name__] = define
    return define


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_summary(documents(spark, folder))


@_query
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.round_trip(_table(spark, folder, "pages"), scratch_path(spark, "warc"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(documents(spark, folder), _table(spark, folder, "labels"))


@_query
def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return iblt.fingerprint_versions(documents(spark, folder))


@_query
def op5_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.linked_conversations(_table(spark, folder, "conversations"))


@_query
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_matches(documents(spark, folder))


@_query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, folder), _table(spark, folder, "benchmark"))


@_query
def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_components(documents(spark, folder))


@_query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_sequences(
        documents(spark, folder), vocabulary_path("word_bpe_49k.json")
    )


@_query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(
        documents(spark, folder), vocabulary_path("byte_bpe_50k.json")
    )


@_query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.node_summary(_table(spark, folder, "conversations"))


@_query
def op12_minhash_join(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_join.minhash_components(documents(spark, folder))


@_query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    rewritten = infill.restored(infill.fill_in_middle(documents(spark, folder)))
    return rewritten.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )
