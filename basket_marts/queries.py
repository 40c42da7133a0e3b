"""Every query by name, over the shared tables: `QUERIES[name](spark, folder)`."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basket_marts import schemas
from basket_marts.operators import dimension_join, skew
from basket_marts.operators.distinct import distinct_counts, distinct_state, merge_distinct
from basket_marts.operators.outliers import spread_stats
from basket_marts.plans import batch, benchmark, cleaning, marts, merging, quality, reads
from basket_marts.plans.colocated import ColocatedTables
from basket_marts.plans.incremental import BasketState
from basket_marts.plans.stages import StageLog
from basket_marts.schemas import DIMENSIONS, MART_CONTRACTS
from basket_marts.session import remove_folder, session_path
from basket_marts.sinks import publish_mart, to_catalog, to_parquet
from basket_marts.sources import Lake, PartitionedTable, RawFiles, SharedTables, read_csv
from basket_marts.sources.raw_files import split_of_file

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _query(define: Callable[[SharedTables], DataFrame]) -> Callable[[SharedTables], DataFrame]:
    QUERIES[define.__name__] = lambda spark, folder: define(SharedTables(spark, folder))
    return define


def _items(tables: SharedTables) -> DataFrame:
    return cleaning.clean_items(tables.tagged_items())


def _labels(tables: SharedTables) -> DataFrame:
    return marts.product_labels(tables.products(), tables.departments(), tables.aisles())


def _totals(tables: SharedTables) -> DataFrame:
    return marts.product_totals(_items(tables))


def _baskets_of_items(tables: SharedTables, items: DataFrame) -> DataFrame:
    return marts.orders_with_baskets(tables.orders(), marts.order_baskets(items))


def _baskets_of(orders: DataFrame, tables: SharedTables) -> DataFrame:
    return marts.orders_with_baskets(orders, marts.order_baskets(_items(tables)))


# Cleaning, over the dirty view -------------------------------------------------------


@_query
def clean_order_products(tables: SharedTables) -> DataFrame:
    return cleaning.clean_order_products(
        tables.prior_items(dirty=True), tables.train_items(dirty=True)
    )


@_query
def clean_orders(tables: SharedTables) -> DataFrame:
    return cleaning.clean_orders(tables.orders(dirty=True))


@_query
def clean_dimensions(tables: SharedTables) -> DataFrame:
    raw = (
        tables.products(dirty=True),
        tables.aisles(dirty=True),
        tables.departments(dirty=True),
    )
    products, aisles, departments = (
        cleaning.clean_dimension(rows, dimension.key).select(
            F.lit(dimension.name).alias("dimension"),
            F.col(dimension.key).cast("bigint").alias("id"),
            F.col(dimension.label).alias("name"),
        )
        for dimension, rows in zip(DIMENSIONS, raw)
    )
    return products.unionByName(aisles).unionByName(departments)


# Items and the marts over them -------------------------------------------------------


@_query
def enrich_items(tables: SharedTables) -> DataFrame:
    return marts.enrich_items(_items(tables), _labels(tables)).select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        "reordered",
        "eval_set",
        "product_name",
        "aisle_id",
        "department_id",
        "aisle",
        "department",
    )


@_query
def mart_department_kpis(tables: SharedTables) -> DataFrame:
    return marts.department_kpis(tables.tagged_items(), _labels(tables), _totals(tables))


@_query
def aisle_rate_stats(tables: SharedTables) -> DataFrame:
    stats = spread_stats(marts.aisle_rates(_labels(tables), _totals(tables)), "reorder_rate")
    # Twelve digits: beyond that the order of a floating-point sum shows.
    return stats.select(*(F.round(c, 12).alias(c) for c in stats.columns))


@_query
def mart_aisle_reorder(tables: SharedTables) -> DataFrame:
    return marts.aisle_reorder(marts.aisle_rates(_labels(tables), _totals(tables)))


@_query
def mart_product_rank(tables: SharedTables) -> DataFrame:
    return marts.product_rank(_labels(tables), _totals(tables))


# Orders and the marts over them ------------------------------------------------------


@_query
def order_baskets(tables: SharedTables) -> DataFrame:
    return marts.order_baskets(_items(tables))


@_query
def orders_with_baskets(tables: SharedTables) -> DataFrame:
    return _baskets_of(tables.orders(), tables)


@_query
def mart_hourly_demand(tables: SharedTables) -> DataFrame:
    return marts.hourly_demand(_baskets_of(tables.order_slots(), tables))


@_query
def mart_user_cohort(tables: SharedTables) -> DataFrame:
    return marts.user_cohort(_baskets_of(tables.orders(), tables))


@_query
def mart_user_cohort_cap10(tables: SharedTables) -> DataFrame:
    return marts.user_cohort(_baskets_of(tables.orders(), tables), cap=10)


# Quality ----------------------------------------------------------------------------


@_query
def orphan_items(tables: SharedTables) -> DataFrame:
    known = tables.products().where(F.col("product_id") % 97 != 0)
    return quality.orphan_items(_items(tables), known).select(
        "order_id", "product_id", "add_to_cart_order", "reordered", "eval_set"
    )


def _kept(tables: SharedTables, rows: DataFrame, label: str) -> DataFrame:
    """Rows that a query uses several times, computed once and read from the scratch folder."""
    path = session_path(tables.spark, label, tables.root)
    rows.write.mode("overwrite").parquet(path)
    return tables.spark.read.schema(rows.schema).parquet(path)


@_query
def dq_report(tables: SharedTables) -> DataFrame:
    # Only the deduplicated items are stored. The report is one plan, in which Spark reuses the
    # shuffles of what several marts share.
    items = _kept(tables, _items(tables), "items")
    frames = batch.mart_frames(
        items, _labels(tables), marts.product_totals(items), _baskets_of_items(tables, items)
    )
    return quality.quality_report(items, tables.order_slots(), tables.products(), frames)


@_query
def dq_report_dirty(tables: SharedTables) -> DataFrame:
    items = cleaning.tagged_items(tables.prior_items(dirty=True), tables.train_items(dirty=True))
    return quality.table_report(
        items, tables.order_slots(dirty=True), tables.products(dirty=True)
    )


# Publishing and read side -----------------------------------------------------------


def _published(name: str, mart: Callable[[SharedTables], DataFrame]) -> None:
    """A mart published as Parquet and read back."""

    def query(tables: SharedTables) -> DataFrame:
        root = session_path(tables.spark, "published", tables.root)
        publish_mart(mart(tables), name, MART_CONTRACTS[name], to_parquet(root))
        return tables.spark.read.parquet(f"{root}/{name}")

    query.__name__ = name.replace("mart_", "published_")
    _query(query)


_published("mart_department_kpis", mart_department_kpis)
_published("mart_aisle_reorder", mart_aisle_reorder)
_published("mart_product_rank", mart_product_rank)
_published("mart_hourly_demand", mart_hourly_demand)
# Uncapped, the last cohort may be one order without items; such a mart is refused.
_published("mart_user_cohort", mart_user_cohort_cap10)


@_query
def hourly_pivot(tables: SharedTables) -> DataFrame:
    return reads.hourly_pivot(mart_hourly_demand(tables))


@_query
def departments_by_rate(tables: SharedTables) -> DataFrame:
    return reads.departments_by_rate(mart_department_kpis(tables))


# Benchmark --------------------------------------------------------------------------


@_query
def join_shuffle(tables: SharedTables) -> DataFrame:
    return benchmark.shuffle_join_count(_items(tables), tables.products())


@_query
def join_preaggregated(tables: SharedTables) -> DataFrame:
    return benchmark.merged_join_count(_items(tables), tables.products())


@_query
def join_broadcast(tables: SharedTables) -> DataFrame:
    return benchmark.broadcast_join_count(_items(tables), tables.products())


@_query
def reordered_counts(tables: SharedTables) -> DataFrame:
    return benchmark.reordered_counts(_items(tables))


@_query
def csv_scan_counts(tables: SharedTables) -> DataFrame:
    """Both splits written as headered CSV, read back as one table, counted."""
    root = session_path(tables.spark, "csv", tables.root)
    files = {f"{root}/prior": tables.prior_items(), f"{root}/train": tables.train_items()}
    for path, rows in files.items():
        rows.write.mode("overwrite").csv(path, header=True)
    schema = "order_id BIGINT, product_id BIGINT, add_to_cart_order INT, reordered INT"
    return benchmark.reordered_counts(read_csv(tables.spark, list(files), schema))


@_query
def key_skew(tables: SharedTables) -> DataFrame:
    return skew.key_skew(_items(tables), "product_id")


SKETCH_BUCKETS = 8


@_query
def key_skew_sketch(tables: SharedTables) -> DataFrame:
    """The skew from sketches that were stored bucket by bucket and merged, beside the exact
    median; `within_bound` holds the rank of the merged median against the sketch's bound."""
    items = _kept(tables, _items(tables).select("product_id"), "sold")
    sketches = _kept(tables, skew.count_sketches(items, "product_id", SKETCH_BUCKETS), "sketches")
    merged = skew.sketched_skew(sketches)
    exact = skew.rank_error(items, "product_id", merged.select("median_rows").scalar())
    return merged.select(
        "n_keys",
        "max_rows",
        exact.select("median_rows").scalar().alias("median_rows"),
        (exact.select("rank_error").scalar() <= skew.sketch_rank_error()).alias("within_bound"),
    )


# Accounting for raw rows --------------------------------------------------------------


def _broken_lake(tables: SharedTables) -> Lake:
    """A drop with broken lines, cleaned with an account of all its rows."""
    root = session_path(tables.spark, "broken", tables.root)
    lines = {
        schemas.ORDERS_FILE: tables.broken_order_lines(),
        schemas.PRIOR_ITEMS_FILE: tables.broken_item_lines(schemas.PRIOR),
        schemas.TRAIN_ITEMS_FILE: tables.broken_item_lines(schemas.TRAIN),
    }
    for file, rows in lines.items():
        # One column whose name is the header line; without separators in it nothing is quoted.
        rows.write.mode("overwrite").csv(f"{root}/raw/{file}", header=True, sep="\x01")
    for dimension in DIMENSIONS:
        rows = _raw_drop(tables, dirty=True)[dimension.file]
        rows.write.mode("overwrite").csv(f"{root}/raw/{dimension.file}", header=True)
    batch.clean_audited(tables.spark, f"{root}/raw", f"{root}/lake")
    return Lake(tables.spark, f"{root}/lake")


@_query
def csv_rejects(tables: SharedTables) -> DataFrame:
    """Every raw item and order that did not become a row, why, and from which split."""
    lake = _broken_lake(tables)
    items = lake.rejects("order_products").withColumn("split", split_of_file(F.col("file")))
    orders = lake.rejects("orders").withColumn("split", F.lit(None).cast("string"))
    return items.unionByName(orders).select("table_name", "split", "reason", "record")


@_query
def csv_accounts(tables: SharedTables) -> DataFrame:
    """Rows read of each raw table, and what became of them."""
    return _broken_lake(tables).accounts()


@_query
def csv_split_counts(tables: SharedTables) -> DataFrame:
    """Items of both splits, in one scan of files that name their split."""
    root = session_path(tables.spark, "splits", tables.root)
    files = {schemas.PRIOR_ITEMS_FILE: tables.prior_items(), schemas.TRAIN_ITEMS_FILE: tables.train_items()}
    for file, rows in files.items():
        rows.write.mode("overwrite").csv(f"{root}/{file}", header=True)
    items = RawFiles(tables.spark, root).tagged_items()
    return items.groupBy("eval_set", "reordered").agg(F.count(F.lit(1)).alias("n_items"))


# Late drops and corrected weekdays ------------------------------------------------------

# Few ids to a range, so that small tables have several, and a bound on the ranges of large
# ones: each is a folder of every table, whose files are opened, listed and moved one by one.
DROP_SPAN = 4096
MOST_RANGES = 128


def _new_folder(tables: SharedTables, label: str) -> str:
    root = session_path(tables.spark, label, tables.root)
    remove_folder(tables.spark, root)
    return root


def _drop_span(*tables: DataFrame) -> int:
    """Ids to a range: `DROP_SPAN`, or as many times more as leave `MOST_RANGES` at most."""
    ids = reduce(DataFrame.unionByName, (t.select("order_id") for t in tables))
    span = DROP_SPAN
    while (n_ranges := ids.agg(F.count_distinct(merging.order_range(span))).first()[0]) > MOST_RANGES:
        span = min(span * -(-n_ranges // MOST_RANGES), 1 << 62)
    return span


def _drops(items: DataFrame, span: int) -> list[DataFrame]:
    """Three drops: half of the items, and the rest in ranges of even and of odd number."""
    late = F.col("add_to_cart_order") % 2 == 0
    even = merging.order_range(span) % 2 == 0
    return [items.where(~late), items.where(late & even), items.where(late & ~even)]


@_query
def merged_items(tables: SharedTables) -> DataFrame:
    """Cleaned items of the dirty view as three drops left them, each merged into what it touched."""
    items = cleaning.tagged_items(tables.prior_items(dirty=True), tables.train_items(dirty=True))
    table = merging.items_by_range(tables.spark, _new_folder(tables, "merged-items"))
    span = _drop_span(items)
    for drop in _drops(items, span):
        merging.merge_items(table, drop, span)
    return table.rows().drop(merging.RANGE)


RERUN_WEEKDAY = 3


def _rerun_orders(tables: SharedTables) -> PartitionedTable:
    """Orders stored with wrong hours, of which one weekday was then run again."""
    raw = tables.orders(dirty=True)
    table = merging.orders_by_weekday(tables.spark, _new_folder(tables, "weekday-orders"))
    wrong = cleaning.clean_orders(raw.withColumn("order_hour_of_day", F.lit(0)))
    table.replace(wrong, [None, *range(7)])
    merging.rerun_weekdays(table, raw, [RERUN_WEEKDAY])
    return table


@_query
def rerun_weekday(tables: SharedTables) -> DataFrame:
    return _rerun_orders(tables).rows()


@_query
def rerun_weekday_demand(tables: SharedTables) -> DataFrame:
    """Orders by hour of the weekday run again; no other weekday is read."""
    orders = _rerun_orders(tables).rows([RERUN_WEEKDAY])
    return orders.groupBy("order_dow", F.col("order_hour_of_day").alias("order_hour")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


@_query
def merged_department_orders(tables: SharedTables) -> DataFrame:
    """Different orders of each department from bitmaps of both splits, stored and merged."""
    labels = _labels(tables).select("product_id", "department")
    states = []
    for split, items in ((schemas.PRIOR, tables.prior_items()), (schemas.TRAIN, tables.train_items())):
        named = dimension_join(
            items.select("order_id", "product_id"), labels, "product_id", spread_by=["order_id"]
        )
        state = distinct_state(named, ["department"], "order_id")
        states.append(_kept(tables, state, f"department-orders-{split}"))
    return distinct_counts(merge_distinct(states, ["department"]), ["department"], "n_orders")


def _state_after_drops(tables: SharedTables, label: str) -> tuple[BasketState, DataFrame]:
    root = _new_folder(tables, label)
    items = merging.items_by_range(tables.spark, f"{root}/items")
    labels = _kept(tables, _labels(tables), f"{label}-labels")
    orders, tagged = tables.order_slots(), tables.tagged_items()
    span = _drop_span(orders, tagged)
    state = BasketState(tables.spark, f"{root}/state", items, span)
    first, *late = _drops(tagged, span)
    merging.merge_items(items, first, span)
    # Orders that have no item yet count as well.
    ranges = items.values_of(orders.withColumn(merging.RANGE, merging.order_range(span)))
    state.refresh(labels, orders, ranges)
    for drop in late:
        state.take_in(drop, labels, orders)
    return state, labels


@_query
def incremental_department_kpis(tables: SharedTables) -> DataFrame:
    state, labels = _state_after_drops(tables, "incremental-departments")
    return state.department_kpis(labels)


@_query
def incremental_aisle_reorder(tables: SharedTables) -> DataFrame:
    state, labels = _state_after_drops(tables, "incremental-aisles")
    return state.aisle_reorder(labels)


@_query
def incremental_hourly_demand(tables: SharedTables) -> DataFrame:
    return _state_after_drops(tables, "incremental-hours")[0].hourly_demand()


# The catalog --------------------------------------------------------------------------


def _published_in_catalog(name: str, mart: Callable[[SharedTables], DataFrame]) -> None:
    """A mart published twice, first without a row of it, and read through its view."""

    def query(tables: SharedTables) -> DataFrame:
        writer = to_catalog("basket_published", session_path(tables.spark, "catalog", tables.root))
        rows = _kept(tables, mart(tables), f"to-publish-{name}")
        contract = MART_CONTRACTS[name]
        publish_mart(rows.where("false"), name, contract, writer)
        publish_mart(rows, name, contract, writer)
        return tables.spark.table(f"basket_published.{name}")

    query.__name__ = name.replace("mart_", "published_catalog_")
    _query(query)


_published_in_catalog("mart_department_kpis", mart_department_kpis)
_published_in_catalog("mart_product_rank", mart_product_rank)

BASKET_BUCKETS = 8


def _colocated(tables: SharedTables) -> ColocatedTables:
    root = session_path(tables.spark, "colocated", tables.root)
    return ColocatedTables(tables.spark, "basket_colocated", root, BASKET_BUCKETS)


@_query
def colocated_orders_with_baskets(tables: SharedTables) -> DataFrame:
    """Orders with their baskets from tables bucketed by order: stored once, joined without a shuffle."""
    stored = _colocated(tables)
    stored.write(_items(tables), tables.orders())
    return stored.orders_with_baskets()


@_query
def metrics_history(tables: SharedTables) -> DataFrame:
    """The size figures of two runs, the first over one split only, and how they changed."""
    path = _new_folder(tables, "metrics")
    items = _kept(tables, _items(tables).select("product_id", "eval_set"), "measured")
    runs = {"run 1": items.where(F.col("eval_set") == schemas.PRIOR), "run 2": items}
    for run, rows in runs.items():
        benchmark.append_metrics(benchmark.size_metrics(rows), path, run)
    return benchmark.compare_runs(benchmark.metrics_history(tables.spark, path), *benchmark.SIZE_METRICS)


# The batch --------------------------------------------------------------------------


def _raw_drop(tables: SharedTables, dirty: bool) -> dict[str, DataFrame]:
    """The tables, or their dirty view, by raw file."""
    return {
        schemas.ORDERS_FILE: tables.orders(dirty),
        schemas.PRIOR_ITEMS_FILE: tables.prior_items(dirty),
        schemas.TRAIN_ITEMS_FILE: tables.train_items(dirty),
        "products.csv": tables.products(dirty),
        "aisles.csv": tables.aisles(dirty),
        "departments.csv": tables.departments(dirty),
    }


def _cleaned_lake(tables: SharedTables) -> tuple[str, dict[str, int]]:
    """The dirty view as raw CSV files, cleaned into a lake; its folder and rows written."""
    root = session_path(tables.spark, "batch", tables.root)
    for file, rows in _raw_drop(tables, dirty=True).items():
        rows.write.mode("overwrite").csv(f"{root}/raw/{file}", header=True)
    return f"{root}/lake", batch.clean(tables.spark, f"{root}/raw", f"{root}/lake")


@_query
def lake_row_counts(tables: SharedTables) -> DataFrame:
    """Rows of each table as observed while the lake was written."""
    _, written = _cleaned_lake(tables)
    return tables.spark.createDataFrame(list(written.items()), "table_name string, n_rows bigint")


@_query
def batch_marts(tables: SharedTables) -> DataFrame:
    """All marts of a batch over the dirty view, read back, in one frame."""
    root, _ = _cleaned_lake(tables)
    batch.build_marts(tables.spark, root)
    lake = Lake(tables.spark, root)
    none = F.lit(None).cast("double")
    hour = F.concat_ws(" ", "order_dow", "order_hour")
    place = F.concat_ws(" ", "department", "rnk", "product_name")
    shapes = {
        "mart_department_kpis": (F.col("department"), "n_orders", F.col("reorder_rate")),
        "mart_aisle_reorder": (F.col("aisle"), "n_items", F.col("zscore")),
        "mart_product_rank": (place, "n_items", none),
        "mart_hourly_demand": (hour, "n_orders", F.col("avg_basket_size")),
        "mart_user_cohort": (F.col("order_number").cast("string"), "n_orders", F.col("reorder_rate")),
    }
    parts = [
        lake.mart(name).select(
            F.lit(name).alias("mart"),
            key.alias("key"),
            F.col(n).alias("n"),
            figure.alias("figure"),
        )
        for name, (key, n, figure) in shapes.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def dq_report_lake(tables: SharedTables) -> DataFrame:
    """The contract checks over a lake and marts as a batch has written them."""
    root, _ = _cleaned_lake(tables)
    batch.build_marts(tables.spark, root)
    return batch.lake_report(tables.spark, root)


@_query
def batch_stage_rows(tables: SharedTables) -> DataFrame:
    """Rows of each stage's outputs, from the manifests of a batch that was stopped after its first
    stage and then resumed, up to the checks."""
    root, raw = _new_folder(tables, "stages"), session_path(tables.spark, "stages-raw", tables.root)
    for file, rows in _raw_drop(tables, dirty=False).items():
        rows.write.mode("overwrite").csv(f"{raw}/{file}", header=True)
    stages = batch.batch_stages(tables.spark, raw, f"{root}/lake", to_parquet(f"{root}/published"))[:3]
    log = StageLog(tables.spark, f"{root}/lake/stages")
    log.run(stages[:1])
    if log.run(stages) != [stage.name for stage in stages[1:]]:
        raise RuntimeError("a finished stage ran again")
    rows = [
        (stage.name, output, n)
        for stage in stages
        for output, n in log.manifest(stage.name).figures.items()
    ]
    return tables.spark.createDataFrame(rows, "stage string, output string, n_rows bigint")
