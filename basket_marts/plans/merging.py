"""Late drops and corrected weekdays: only the partitions that they touch are rewritten."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basket_marts.plans.cleaning import clean_items, clean_orders
from basket_marts.session import in_scratch
from basket_marts.sources.partitioned import PartitionedTable

# Order ids to a partition.
ORDER_SPAN = 1 << 20
RANGE = "order_range"

LAKE_ITEMS = (
    "order_id BIGINT, product_id BIGINT, add_to_cart_order INT, reordered INT, eval_set STRING"
)
LAKE_ORDERS = (
    "order_id BIGINT, user_id BIGINT, eval_set STRING, order_number INT, "
    "order_hour_of_day INT, days_since_prior_order DOUBLE"
)


def order_range(span: int = ORDER_SPAN) -> Column:
    """The partition of an order. It follows from the key, so copies meet in one partition, and
    the orders of a day, whose ids are near each other, touch few."""
    return F.floor(F.col("order_id") / span).cast("bigint")


@dataclass(frozen=True)
class Merged:
    """Partitions that a drop touched, rows they have now, rows they had before."""

    touched: list
    rows: int
    rows_before: int


def items_by_range(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, LAKE_ITEMS, RANGE)


def merge_drop(
    table: PartitionedTable,
    drop: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    partition: Column,
) -> Merged:
    """Clean a raw drop together with the rows that are stored in the partitions it touches.

    The survivor of a key is the least of its copies, so the least of a stored survivor and the
    new copies is the survivor of all: drops may come in any order, twice, or overlap, and the
    table is as if it had been cleaned whole. Partitions that the drop does not touch are
    neither read nor written. `partition` must follow from the key.
    """
    place = partition.alias(table.partition)
    with in_scratch(clean(drop).select("*", place), "drop") as survivors:
        touched = table.values_of(survivors)
        if not touched:
            return Merged([], 0, 0)
        stored = table.rows(touched)
        rows_before = stored.agg(F.count(F.lit(1))).first()[0]
        both = stored.drop(table.partition).unionByName(survivors.drop(table.partition))
        rows = table.replace(clean(both).select("*", place), touched)
    return Merged(touched, rows, rows_before)


def merge_items(table: PartitionedTable, drop: DataFrame, span: int = ORDER_SPAN) -> Merged:
    """`merge_drop` for tagged order items."""
    return merge_drop(table, drop, clean_items, order_range(span))


# Weekdays ---------------------------------------------------------------------------------


class MovedOrders(Exception):
    """Orders of the weekdays to be replaced are also stored under others. Nothing was written."""


def orders_by_weekday(spark: SparkSession, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, LAKE_ORDERS, "order_dow", "INT")


def rerun_weekdays(table: PartitionedTable, raw: DataFrame, weekdays: Sequence[int | None]) -> int:
    """Replace some weekdays by what a whole raw drop now says of them; returns their rows.

    Copies of an order are compared across all weekdays, as in a whole run, and the survivors of
    these weekdays written. An order that the drop has moved here from a weekday that is not
    replaced would be stored twice: that is an error before anything is written, and the
    remedy is to name both weekdays. Files of other weekdays stay as they are; of these only
    the keys are read.
    """
    survivors = clean_orders(raw).where(table.among(weekdays))
    with in_scratch(survivors, "weekdays") as rows:
        others = table.rows().where(~F.coalesce(table.among(weekdays), F.lit(False)))
        moved = others.select("order_id").join(rows.select("order_id"), "order_id", "left_semi")
        n_moved = moved.agg(F.count(F.lit(1))).first()[0]
        if n_moved:
            raise MovedOrders(f"{n_moved} orders are stored under other weekdays")
        return table.replace(rows, weekdays)
