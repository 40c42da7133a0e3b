"""Marts from state tables that a late drop updates in part.

A state has the same partitions as the items, the ranges of order ids, so after a drop only the
states of the touched ranges are computed anew, from those ranges alone. Nothing is ever
subtracted, and an update that failed is simply run again. Sums and counts add up over
ranges, bitmaps are or-ed; rates, ranks and z-scores are derived when a mart is asked for.

Department names are part of a state: when products move between departments, refresh all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basket_marts.operators import dimension_join
from basket_marts.operators.distinct import distinct_counts, distinct_state, merge_distinct
from basket_marts.plans import marts
from basket_marts.plans.merging import ORDER_SPAN, RANGE, Merged, merge_items, order_range
from basket_marts.sources.partitioned import PartitionedTable

SUMS = ("items", "reordered_sum", "reordered_known", "position_sum", "position_known")
TOTALS_STATE = "product_id BIGINT, " + ", ".join(f"{name} BIGINT" for name in SUMS)
DEPARTMENTS_STATE = "department STRING, bucket BIGINT, bitmap BINARY"
SLOTS_STATE = (
    "order_dow INT, order_hour_of_day INT, n_orders BIGINT, basket_sum BIGINT, basket_known BIGINT"
)


@dataclass(frozen=True)
class BasketState:
    """Items below `root`, and what the marts need of them, by range of order ids."""

    spark: SparkSession
    root: str
    items: PartitionedTable
    span: int = ORDER_SPAN

    def _table(self, name: str, schema: str) -> PartitionedTable:
        return PartitionedTable(self.spark, f"{self.root}/{name}", schema, RANGE)

    @property
    def _totals(self) -> PartitionedTable:
        return self._table("product_totals", TOTALS_STATE)

    @property
    def _departments(self) -> PartitionedTable:
        return self._table("department_orders", DEPARTMENTS_STATE)

    @property
    def _slots(self) -> PartitionedTable:
        return self._table("order_slots", SLOTS_STATE)

    def refresh(self, labels: DataFrame, orders: DataFrame, ranges: Sequence) -> None:
        """Compute the states of some ranges anew from the items and orders in them."""
        items = self.items.rows(ranges)
        self._totals.replace(marts.product_totals(items, RANGE), ranges)
        named = labels.select("product_id", "department")
        touched = dimension_join(
            items.select("order_id", "product_id", RANGE), named, "product_id", spread_by=["order_id"]
        )
        self._departments.replace(distinct_state(touched, [RANGE, "department"], "order_id"), ranges)
        placed = orders.withColumn(RANGE, order_range(self.span)).where(self.items.among(ranges))
        baskets = marts.orders_with_baskets(placed, marts.order_baskets(items))
        slots = baskets.groupBy(RANGE, "order_dow", "order_hour_of_day").agg(
            F.count_distinct("order_id").alias("n_orders"),
            F.sum("basket_size").alias("basket_sum"),
            F.count("basket_size").alias("basket_known"),
        )
        self._slots.replace(slots, ranges)

    def take_in(self, drop: DataFrame, labels: DataFrame, orders: DataFrame) -> Merged:
        """Merge a drop of raw items and bring the states of the ranges that it touches up to date.

        Orders that are new without any item belong to no range of a drop; name their ranges
        to `refresh`.
        """
        merged = merge_items(self.items, drop, self.span)
        if merged.touched:
            self.refresh(labels, orders, merged.touched)
        return merged

    def totals(self) -> DataFrame:
        """`marts.product_totals` of all items, from the sums of the ranges."""
        rows = self._totals.rows()
        return rows.groupBy("product_id").agg(*(F.sum(name).alias(name) for name in SUMS))

    def department_kpis(self, labels: DataFrame) -> DataFrame:
        merged = merge_distinct([self._departments.rows()], ["department"])
        orders = distinct_counts(merged, ["department"], "n_orders")
        return marts.department_kpis_of(marts.department_sums(labels, self.totals()), orders)

    def aisle_reorder(self, labels: DataFrame) -> DataFrame:
        return marts.aisle_reorder(marts.aisle_rates(labels, self.totals()))

    def hourly_demand(self) -> DataFrame:
        """Each order is in one range, so orders add up; mean baskets come from sums."""
        return (
            self._slots.rows()
            .groupBy("order_dow", F.col("order_hour_of_day").alias("order_hour"))
            .agg(
                F.sum("n_orders").alias("n_orders"),
                marts.mean_of("basket_sum", "basket_known", 2).alias("avg_basket_size"),
            )
        )
