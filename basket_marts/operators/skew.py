from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basket_marts.functions import ratio
from basket_marts.session import rows_per_split


def heavy_keys(rows: DataFrame, key: str, *measures: Column) -> DataFrame:
    """Keys with more rows than one task should hold: (key, splits, measures...).

    `splits` is how many tasks the key's rows need. Counting combines before the
    shuffle. Of N rows at most N / rows_per_split keys can qualify, which bounds the
    result for a broadcast.
    """
    limit = rows_per_split(rows.sparkSession)
    return (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"), *measures)
        .where(F.col("n_rows") > limit)
        .withColumn("splits", F.ceil(F.col("n_rows") / limit).cast("int"))
        .drop("n_rows")
    )


def key_skew(rows: DataFrame, key: str) -> DataFrame:
    """One row: largest and median number of rows per key, and their ratio (1 dp)."""
    per_key = rows.groupBy(key).count()
    measured = per_key.agg(
        F.max("count").alias("max_rows"),
        F.percentile_approx("count", 0.5).alias("median_rows"),
    )
    return measured.withColumn(
        "max_to_median", F.round(ratio(F.col("max_rows"), F.col("median_rows")), 1)
    )


# Values that a quantile sketch keeps to a level; its rank error falls with their number.
SKETCH_SIZE = 1024


def sketch_rank_error(size: int = SKETCH_SIZE) -> float:
    """The error of a rank, as a share of all values, that a KLL sketch of this size keeps to in
    99 of 100 cases (the published fit for single quantiles)."""
    return 2.296 / size**0.9723


def count_sketches(rows: DataFrame, key: str, buckets: int, size: int = SKETCH_SIZE) -> DataFrame:
    """(bucket, sketch, max_rows): a quantile sketch of the rows per key, for each bucket of keys.

    A key lies in one bucket, so sketches of different buckets can be stored, replaced one by
    one when a bucket's rows change, and merged. NULL is a key. A sketch has a few dozen KB,
    however many keys there are.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    return counts.groupBy(bucket).agg(
        F.kll_sketch_agg_bigint("n_rows", size).alias("sketch"), F.max("n_rows").alias("max_rows")
    )


def sketched_skew(sketches: DataFrame) -> DataFrame:
    """One row: n_keys, largest and approximate median number of rows per key, their ratio."""
    merged = sketches.agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.max("max_rows").alias("max_rows"))
    median = F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.5)).alias("median_rows")
    found = merged.select(F.kll_sketch_get_n_bigint("sketch").alias("n_keys"), "max_rows", median)
    return found.withColumn("max_to_median", F.round(ratio(F.col("max_rows"), F.col("median_rows")), 1))


def rank_error(rows: DataFrame, key: str, median: Column) -> DataFrame:
    """One row: the exact median of the rows per key, and by how much, as a share of all keys,
    the rank of `median` (a scalar) misses one half."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    below = F.count_if(F.col("n_rows") < median) / F.count(F.lit(1))
    up_to = F.count_if(F.col("n_rows") <= median) / F.count(F.lit(1))
    missed = F.greatest(below - 0.5, 0.5 - up_to, F.lit(0.0))
    return counts.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY n_rows)").cast("bigint").alias("median_rows"), missed.alias("rank_error"))
