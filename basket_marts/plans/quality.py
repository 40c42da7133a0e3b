"""Data contract: one row per check, and a gate that stops the batch on a failure."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basket_marts.functions import any_null, outside_domain, outside_range
from basket_marts.operators import dimension_join
from basket_marts.schemas import ITEM_KEYS, MART_CONTRACTS

# --- Fixed values: names of the checks, as they appear in reports. -------------------

ITEM_KEYS_PRESENT = "order_products.keys_not_null"
ORDER_ID_UNIQUE = "orders.order_id_unique"
ITEM_KEYS_UNIQUE = "order_products.no_dup_keys"
REORDERED_DOMAIN = "order_products.reordered_in_{0,1}"
PRODUCT_EXISTS = "ref_integrity.product_id_in_products"
MART_NOT_EMPTY = "{mart}.not_empty"
MART_RATE_RANGE = "{mart}.reorder_rate_in_[0,1]"

# --- End of fixed values. -----------------------------------------------------------


class ContractViolation(Exception):
    """The batch must not be published. `failed` lists every failed check."""

    def __init__(self, failed: Mapping[str, int]):
        self.failed = dict(failed)
        listed = ", ".join(f"{name} ({n})" for name, n in self.failed.items())
        super().__init__(f"{len(self.failed)} check(s) failed: {listed}")


def orphan_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items whose product is unknown; a NULL product counts as unknown."""
    known = products.select("product_id").distinct()
    return dimension_join(items, known, "product_id", spread_by=["order_id"], how="left_anti")


def _total(counted: Column) -> Column:
    return F.coalesce(F.sum(counted), F.lit(0)).cast("bigint")


def _report(measures: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """Turn a one-row frame of violation counts into one row per check."""
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("check_name"), F.col(column).alias("violations"))
            for column, name in checks.items()
        )
    )
    return measures.select(F.inline(rows)).select(
        "check_name", (F.col("violations") == 0).alias("ok"), "violations"
    )


def item_checks(items: DataFrame, products: DataFrame) -> DataFrame:
    """Keys present, keys unique, flag in its domain, product known: one scan of items.

    Counts go from (order, product) to product to a total, each step combined before
    its shuffle. The products join sees every product once, however often it was sold.
    """
    rows = F.col("rows")
    per_key = items.groupBy(*ITEM_KEYS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(outside_domain("reordered", 0, 1)).alias("bad_flags"),
    )
    per_product = per_key.groupBy("product_id").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(any_null(*ITEM_KEYS), rows)).alias("null_keys"),
        F.sum(rows - 1).alias("repeats"),
        F.sum("bad_flags").alias("bad_flags"),
    )
    known = products.select("product_id").distinct().withColumn("known", F.lit(True))
    measures = per_product.join(known, "product_id", "left").agg(
        _total(F.col("null_keys")).alias("null_keys"),
        _total(F.col("repeats")).alias("repeats"),
        _total(F.col("bad_flags")).alias("bad_flags"),
        _total(F.when(F.col("known").isNull(), rows)).alias("orphans"),
    )
    return _report(
        measures,
        {
            "null_keys": ITEM_KEYS_PRESENT,
            "repeats": ITEM_KEYS_UNIQUE,
            "bad_flags": REORDERED_DOMAIN,
            "orphans": PRODUCT_EXISTS,
        },
    )


def order_checks(orders: DataFrame) -> DataFrame:
    per_order = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("rows"))
    measures = per_order.agg(_total(F.col("rows") - 1).alias("repeats"))
    return _report(measures, {"repeats": ORDER_ID_UNIQUE})


def mart_checks(name: str, mart: DataFrame) -> DataFrame:
    """An empty mart counts as one violation. Rates are tested where there are any."""
    measures = [F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("empty")]
    checks = {"empty": MART_NOT_EMPTY.format(mart=name)}
    if MART_CONTRACTS[name].has_rate:
        measures.append(F.count_if(outside_range("reorder_rate", 0, 1)).alias("bad_rates"))
        checks["bad_rates"] = MART_RATE_RANGE.format(mart=name)
    return _report(mart.agg(*measures), checks)


def table_report(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    return item_checks(items, products).unionByName(order_checks(orders))


def quality_report(
    items: DataFrame, orders: DataFrame, products: DataFrame, marts: Mapping[str, DataFrame]
) -> DataFrame:
    """(check_name, ok, violations) for the cleaned tables and all five marts."""
    parts = [mart_checks(name, marts[name]) for name in MART_CONTRACTS]
    return reduce(DataFrame.unionByName, parts, table_report(items, orders, products))


def enforce(report: DataFrame) -> list:
    """Run the report; raise `ContractViolation` naming every failed check."""
    rows = report.collect()
    failed = {row.check_name: row.violations for row in rows if not row.ok}
    if failed:
        raise ContractViolation(failed)
    return rows
