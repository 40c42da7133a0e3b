"""Exact distinct counts that can be stored and merged: one bit for every different key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_state(rows: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """(by..., bucket, bitmap): the integer keys of each group, as bits.

    A bitmap has 4 KB and covers 32,768 neighbouring keys. Each map task sets its bits before
    the shuffle, so bitmaps travel and not keys; a group with a third of all rows sends one
    bitmap per bucket and task. Good where keys are dense, as ids of orders are; a key far
    from all others takes a bitmap of its own. NULL keys do not count.
    """
    placed = rows.where(F.col(key).isNotNull()).select(
        *by,
        F.bitmap_bucket_number(key).alias("bucket"),
        F.bitmap_bit_position(key).alias("_bit"),
    )
    return placed.groupBy(*by, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def merge_distinct(states: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """One state of several, whose keys may overlap."""
    together = reduce(DataFrame.unionByName, (s.select(*by, "bucket", "bitmap") for s in states))
    return together.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(state: DataFrame, by: Sequence[str], count: str) -> DataFrame:
    """(by..., count) of a merged state. Groups without any key have no row."""
    return state.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(count))
