"""Side-by-side timings of two plan choices, and the skew of the product key."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from statistics import median
from time import perf_counter

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basket_marts.functions import ratio
from basket_marts.operators import dimension_join, key_skew, salted_join
from basket_marts.session import scoped_conf
from basket_marts.sinks import run_to_nowhere
from basket_marts.sources import Lake, RawFiles

# The fields of the metrics document.
SIZE_METRICS = (
    "rows_order_products",
    "skew_product_id_max_rows",
    "skew_product_id_median_rows",
    "skew_ratio_max_to_median",
)
METRICS_SCHEMA = (
    "rows_order_products BIGINT, testA_shuffle_join_sec DOUBLE, testA_broadcast_join_sec DOUBLE, "
    "testA_speedup_x DOUBLE, testB_csv_read_sec DOUBLE, testB_parquet_read_sec DOUBLE, "
    "testB_speedup_x DOUBLE, skew_product_id_max_rows BIGINT, skew_product_id_median_rows BIGINT, "
    "skew_ratio_max_to_median DOUBLE"
)


def _count_by(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_items"))


def shuffle_join_count(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items per department, every item shuffled to a sort-merge join. Heavy products
    are split over several tasks."""
    joined = salted_join(
        items.select("order_id", "product_id"),
        products.select("product_id", "department_id"),
        "product_id",
        spread_by=["order_id"],
    )
    return _count_by(joined, "department_id")


def merged_join_count(items: DataFrame, products: DataFrame) -> DataFrame:
    """The same counts with items counted per product before the sort-merge join: each
    map task sends a product once, so neither volume nor skew reaches the join."""
    per_product = _count_by(items, "product_id")
    departments = products.select("product_id", "department_id").hint("merge")
    return (
        per_product.join(departments, "product_id")
        .groupBy("department_id")
        .agg(F.sum("n_items").alias("n_items"))
    )


def broadcast_join_count(items: DataFrame, products: DataFrame) -> DataFrame:
    """The same counts with the products sent to the items, if their size allows it."""
    joined = dimension_join(
        items.select("order_id", "product_id"),
        products.select("product_id", "department_id"),
        "product_id",
        spread_by=["order_id"],
    )
    return _count_by(joined, "department_id")


def reordered_counts(items: DataFrame) -> DataFrame:
    return _count_by(items, "reordered")


def seconds(run: Callable[[], None]) -> float:
    start = perf_counter()
    run()
    return perf_counter() - start


def compare(variants: Mapping[str, Callable[[], None]], repeats: int = 5) -> dict[str, float]:
    """Median seconds per variant: each is run once to warm up, then all take turns."""
    for run in variants.values():
        run()
    taken: dict[str, list[float]] = {name: [] for name in variants}
    for _ in range(repeats):
        for name, run in variants.items():
            taken[name].append(seconds(run))
    return {name: round(median(times), 3) for name, times in taken.items()}


def compare_joins(items: DataFrame, products: DataFrame, repeats: int = 5) -> dict[str, float]:
    """AQE and automatic broadcasts are off for these runs only, so that each variant
    keeps the join it names."""
    spark = items.sparkSession
    with scoped_conf(
        spark,
        spark__sql__adaptive__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
    ):
        return compare(
            {
                "shuffle_join": lambda: run_to_nowhere(shuffle_join_count(items, products)),
                "broadcast_join": lambda: run_to_nowhere(broadcast_join_count(items, products)),
            },
            repeats,
        )


def compare_formats(raw_items: DataFrame, lake_items: DataFrame, repeats: int = 5) -> dict:
    """The same grouped count over CSV and over Parquet. CSV rows are uncleaned, so the
    groups agree only where cleaning changes nothing."""
    return compare(
        {
            "csv": lambda: run_to_nowhere(reordered_counts(raw_items)),
            "parquet": lambda: run_to_nowhere(reordered_counts(lake_items)),
        },
        repeats,
    )


def metrics(spark: SparkSession, raw_root: str, lake_root: str, repeats: int = 5) -> DataFrame:
    """All figures of the benchmark as one row."""
    lake = Lake(spark, lake_root)
    items, products = lake.table("order_products"), lake.table("products")
    joins = compare_joins(items, products, repeats)
    formats = compare_formats(RawFiles(spark, raw_root).all_items(), items, repeats)

    def faster(slow: float, fast: float):
        return F.round(ratio(F.lit(slow), F.lit(fast)), 2)

    size = size_metrics(items)
    # The field names of the metrics document.
    return size.select(
        "rows_order_products",
        F.lit(joins["shuffle_join"]).alias("testA_shuffle_join_sec"),
        F.lit(joins["broadcast_join"]).alias("testA_broadcast_join_sec"),
        faster(joins["shuffle_join"], joins["broadcast_join"]).alias("testA_speedup_x"),
        F.lit(formats["csv"]).alias("testB_csv_read_sec"),
        F.lit(formats["parquet"]).alias("testB_parquet_read_sec"),
        faster(formats["csv"], formats["parquet"]).alias("testB_speedup_x"),
        *(c for c in size.columns if c != "rows_order_products"),
    )


def size_metrics(items: DataFrame) -> DataFrame:
    """The figures that do not depend on the machine, as one row."""
    total = items.agg(F.count(F.lit(1)).alias("n")).scalar()
    return key_skew(items, "product_id").select(
        total.alias("rows_order_products"),
        F.col("max_rows").alias("skew_product_id_max_rows"),
        F.col("median_rows").alias("skew_product_id_median_rows"),
        F.col("max_to_median").alias("skew_ratio_max_to_median"),
    )


def append_metrics(figures: DataFrame, path: str, run: str) -> None:
    """Add a one-row document to a history. `run` names it and sorts after earlier runs."""
    figures.withColumn("run", F.lit(run)).coalesce(1).write.mode("append").json(path)


def metrics_history(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a history under one schema. A field that a document lacks is NULL."""
    return spark.read.schema(f"run STRING, {METRICS_SCHEMA}").json(path)


def compare_runs(history: DataFrame, *figures: str) -> DataFrame:
    """(run, figure, value, previous, change): each figure beside that of the run before, and the
    change as a share of it (4 dp; NULL without an earlier value or where that is 0).
    """
    long = history.select("run", *(F.col(f).cast("double") for f in figures)).unpivot(
        "run", list(figures), "figure", "value"
    )
    previous = F.lag("value").over(Window.partitionBy("figure").orderBy("run"))
    return long.withColumn("previous", previous).withColumn(
        "change", F.round(ratio(F.col("value") - F.col("previous"), F.col("previous")), 4)
    )
