from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    rows: DataFrame, group: str, order: Sequence[Column], n: int, rank: str = "rnk"
) -> DataFrame:
    """First `n` rows of each group, numbered from 1. `order` should be total.

    The `row_number <= n` shape lets Catalyst keep only n rows per group and map task
    before the shuffle, so a dominant group does not reach one task whole.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
