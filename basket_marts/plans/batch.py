"""The batch in order: clean, marts, quality gate, publish. The benchmark stands beside it."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from basket_marts.plans import benchmark, intake, marts, quality
from basket_marts.plans.cleaning import (
    clean_dimension,
    clean_items,
    clean_order_products,
    clean_orders,
)
from basket_marts.plans.stages import Stage, StageLog
from basket_marts.schemas import DIMENSIONS, ITEM_KEYS, MART_CONTRACTS, ORDER_KEYS
from basket_marts.sinks import (
    publish_mart,
    write_compact,
    write_even,
    write_json,
    write_natural,
)
from basket_marts.sinks.publish import ParquetFolder, Writer
from basket_marts.sources import Lake, RawFiles


@contextmanager
def persisted(rows: DataFrame) -> Iterator[DataFrame]:
    """Keep a reused frame in memory or on disk for a block. A lost executor's part is
    computed again from the lake."""
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def clean_audited(
    spark: SparkSession, raw_root: str, lake_root: str, item_files: int | None = None
) -> list[intake.Account]:
    """Raw CSV -> lake, with the rejected rows of each table at `lake/rejects/<table>` and an
    account of all rows at `lake/accounts`. Both item files are one scan.
    """
    raw, lake = RawFiles(spark, raw_root, audited=True), Lake(spark, lake_root)

    def items_written(rows: DataFrame) -> int:
        path = lake.table_path("order_products")
        return write_natural(rows, path) if item_files is None else write_even(rows, path, item_files)

    tables = [
        (
            dimension.name,
            raw.dimension(dimension),
            [dimension.key],
            partial(clean_dimension, key=dimension.key),
            partial(write_compact, path=lake.table_path(dimension.name)),
        )
        for dimension in DIMENSIONS
    ]
    to_orders = partial(write_natural, path=lake.table_path("orders"))
    tables += [
        ("orders", raw.orders(), ORDER_KEYS, clean_orders, to_orders),
        ("order_products", raw.tagged_items(), ITEM_KEYS, clean_items, items_written),
    ]
    accounts = [
        intake.take_in(rows, name, keys, clean, write, lake.rejects_path(name))
        for name, rows, keys, clean, write in tables
    ]
    write_compact(intake.accounts_frame(spark, accounts), lake.accounts_path())
    return accounts


def clean(spark: SparkSession, raw_root: str, lake_root: str, item_files: int | None = None):
    """Raw CSV -> lake. Returns rows written per table; `clean_audited` also tells what became of
    the others.

    Deduplication already spreads items evenly by their key; name `item_files` to get
    exactly that many files instead.
    """
    raw, lake = RawFiles(spark, raw_root), Lake(spark, lake_root)
    written = {}
    for dimension in DIMENSIONS:
        rows = clean_dimension(raw.dimension(dimension), dimension.key)
        written[dimension.name] = write_compact(rows, lake.table_path(dimension.name))
    orders = clean_orders(raw.orders())
    written["orders"] = write_natural(orders, lake.table_path("orders"))
    items, path = clean_order_products(raw.prior_items(), raw.train_items()), "order_products"
    if item_files is None:
        written[path] = write_natural(items, lake.table_path(path))
    else:
        written[path] = write_even(items, lake.table_path(path), item_files)
    return written


def mart_frames(
    items: DataFrame, labels: DataFrame, totals: DataFrame, orders: DataFrame
) -> dict[str, DataFrame]:
    """The five marts. `orders` carries the baskets already."""
    return {
        "mart_department_kpis": marts.department_kpis(items, labels, totals),
        "mart_aisle_reorder": marts.aisle_reorder(marts.aisle_rates(labels, totals)),
        "mart_product_rank": marts.product_rank(labels, totals),
        "mart_hourly_demand": marts.hourly_demand(orders),
        "mart_user_cohort": marts.user_cohort(orders),
    }


def build_marts(spark: SparkSession, lake_root: str) -> dict[str, int]:
    """Lake -> marts. Per-product totals serve three marts and baskets serve two; both
    are kept while the marts are written, far smaller than the enriched items."""
    lake = Lake(spark, lake_root)
    items = lake.table("order_products")
    labels = marts.product_labels(*(lake.table(d) for d in ("products", "departments", "aisles")))
    order_columns = ("order_id", "order_dow", "order_hour_of_day", "order_number")
    with (
        persisted(marts.product_totals(items)) as totals,
        persisted(
            marts.orders_with_baskets(
                lake.table("orders").select(*order_columns), marts.order_baskets(items)
            )
        ) as orders,
    ):
        frames = mart_frames(items, labels, totals, orders)
        return {name: write_compact(rows, lake.mart_path(name)) for name, rows in frames.items()}


def lake_report(spark: SparkSession, lake_root: str) -> DataFrame:
    """The contract checks over the tables and marts of a lake."""
    lake = Lake(spark, lake_root)
    return quality.quality_report(
        *(lake.table(name) for name in ("order_products", "orders", "products")),
        marts={name: lake.mart(name) for name in MART_CONTRACTS},
    )


def check_quality(spark: SparkSession, lake_root: str) -> list:
    """Raise `ContractViolation` if any check on lake or marts fails."""
    return quality.enforce(lake_report(spark, lake_root))


def publish(spark: SparkSession, lake_root: str, writer: Writer) -> dict[str, int]:
    lake = Lake(spark, lake_root)
    return {
        name: publish_mart(lake.mart(name), name, contract, writer)
        for name, contract in MART_CONTRACTS.items()
    }


def run_benchmark(spark: SparkSession, raw_root: str, lake_root: str, metrics_root: str, **kw):
    """The newest figures as `benchmark`, and all so far as `history`."""
    figures = benchmark.metrics(spark, raw_root, lake_root, **kw)
    write_json(figures, f"{metrics_root}/benchmark")
    schema = f"run STRING, {benchmark.METRICS_SCHEMA}"
    kept = spark.read.schema(schema).json(f"{metrics_root}/benchmark").drop("run")
    benchmark.append_metrics(kept, f"{metrics_root}/history", datetime.now(timezone.utc).isoformat())


def batch_stages(
    spark: SparkSession, raw_root: str, lake_root: str, writer: Writer, item_files: int | None = None
) -> list[Stage]:
    """Clean, build, check, publish, as stages that can be resumed. Published marts are only
    known to be there, and so not published again, where the writer writes folders.
    """
    lake = Lake(spark, lake_root)
    tables = [*(d.name for d in DIMENSIONS), "orders", "order_products"]
    cleaned = [lake.table_path(name) for name in tables]
    built = [lake.mart_path(name) for name in MART_CONTRACTS]
    published = [f"{writer.root}/{name}" for name in MART_CONTRACTS] if isinstance(writer, ParquetFolder) else []

    def cleaned_rows() -> dict[str, int]:
        accounts = clean_audited(spark, raw_root, lake_root, item_files)
        return {account.table_name: account.kept for account in accounts}

    return [
        Stage("clean", [raw_root], [*cleaned, lake.accounts_path()], cleaned_rows, {"item_files": item_files}),
        Stage("marts", cleaned, built, lambda: build_marts(spark, lake_root)),
        Stage("checks", [*cleaned, *built], [], lambda: {"passed": len(check_quality(spark, lake_root))}),
        Stage("publish", built, published, lambda: publish(spark, lake_root, writer)),
    ]


def run_batch(
    spark: SparkSession, raw_root: str, lake_root: str, writer: Writer, resume: bool = False
) -> dict[str, int]:
    """Clean, build, check, publish; returns the rows published. A failed check stops the batch
    before publishing. Rejected rows are no failure; they are in the lake, see `clean_audited`.

    Every stage leaves a manifest in the lake. With `resume`, stages that have finished over the
    same files are not run again.
    """
    log = StageLog(spark, f"{lake_root}/stages")
    stages = batch_stages(spark, raw_root, lake_root, writer)
    if not resume:
        for stage in stages:
            log.forget(stage.name)
    log.run(stages)
    return log.manifest("publish").figures
