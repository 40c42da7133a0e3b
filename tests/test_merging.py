"""Late drops, re-run weekdays, and states that follow them."""

from pathlib import Path

import pytest
from conftest import as_rows, plan_of
from pyspark.sql import functions as F

from basket_marts.operators import (
    count_sketches,
    distinct_counts,
    distinct_state,
    key_skew,
    merge_distinct,
    rank_error,
    sketch_rank_error,
    sketched_skew,
)
from basket_marts.plans import marts, merging
from basket_marts.plans.cleaning import clean_items, clean_orders
from basket_marts.plans.incremental import BasketState
from basket_marts.queries import DROP_SPAN, MOST_RANGES, QUERIES, _drop_span
from basket_marts.session import session_path
from basket_marts.sources import PartitionedTable

ITEMS = "order_id bigint, product_id bigint, add_to_cart_order int, reordered int, eval_set string"
SPAN = 100


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def items_of(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def drops():
    """Overlapping drops: repeated keys, survivors replaced by later ones, NULL keys."""
    first = [(o, p, 3, 1, "train") for o in range(0, 400, 7) for p in range(4)] + [(None, 1, 1, 1, "prior")]
    second = [(o, p, 2, None, "prior") for o in range(105, 190, 7) for p in range(2, 6)] + [(5, None, 1, 1, "prior")]
    third = [(o, 1, 9, 0, "train") for o in range(350, 750, 50)] + second[:5]
    return [first, second, third]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 1, 2, 2)])
def test_merged_drops_equal_one_full_clean(spark, tmp_path, order):
    table = merging.items_by_range(spark, f"{tmp_path}/items")
    for n in order:
        merging.merge_items(table, items_of(spark, drops()[n]), SPAN)
    everything = items_of(spark, [row for drop in drops() for row in drop])
    assert as_rows(table.rows().drop(merging.RANGE)) == as_rows(clean_items(everything))


def test_a_drop_leaves_other_partitions_unread_and_unwritten(spark, tmp_path):
    table = merging.items_by_range(spark, f"{tmp_path}/items")
    merging.merge_items(table, items_of(spark, drops()[0]), SPAN)
    before = files(table.path)
    merged = merging.merge_items(table, items_of(spark, [(130, 9, 1, 1, "prior"), (712, 9, 1, 1, "prior")]), SPAN)
    assert merged.touched == [1, 7] and merged.rows == merged.rows_before + 2
    after = files(table.path)
    assert {f for f in before if f not in after} == {f for f in before if "order_range=1/" in f}
    assert all(after[f] == before[f] for f in before if f in after)
    assert {f.split("order_range=")[1][0] for f in after.keys() - before.keys()} == {"1", "7"}
    plan = plan_of(table.rows([1, 7]))
    assert "PartitionFilters: [order_range" in plan
    # Folders that are not asked for may be gone.
    for f in after:
        if "order_range=2/" in f:
            Path(f).write_bytes(b"not Parquet")
    assert table.rows([1, 7]).count() == merged.rows


def test_nothing_to_merge(spark, tmp_path):
    table = merging.items_by_range(spark, f"{tmp_path}/items")
    assert merging.merge_items(table, items_of(spark, [(None, 1, 1, 1, "prior")]), SPAN) == merging.Merged([], 0, 0)
    assert table.rows().count() == 0 and not Path(table.path).exists()


def test_an_interrupted_merge_is_run_again(spark, tmp_path, monkeypatch):
    table = merging.items_by_range(spark, f"{tmp_path}/items")
    merging.merge_items(table, items_of(spark, drops()[0]), SPAN)
    before = as_rows(table.rows())
    drop = items_of(spark, drops()[1])
    broken = drop.withColumn("reordered", F.when(F.col("order_id") > 150, F.raise_error(F.lit("lost"))).otherwise(1))
    with pytest.raises(Exception, match="lost"):
        merging.merge_items(table, broken, SPAN)
    assert as_rows(table.rows()) == before
    merging.merge_items(table, drop, SPAN)
    both = items_of(spark, drops()[0] + drops()[1])
    assert as_rows(table.rows().drop(merging.RANGE)) == as_rows(clean_items(both))


def test_replace_empties_refuses_and_handles_null_partitions(spark, tmp_path):
    table = PartitionedTable(spark, f"{tmp_path}/t", "a INT", "p", "INT")
    table.replace(spark.createDataFrame([(1, 1), (2, 2), (3, None)], "a int, p int"), [1, 2, None])
    assert as_rows(table.rows([None])) == [(3, None)] and table.values_of(table.rows()) == [None, 1, 2]
    with pytest.raises(Exception, match="not replaced"):
        table.replace(spark.createDataFrame([(5, 2)], "a int, p int"), [1])
    assert table.rows().count() == 3
    assert table.replace(table.rows().where("false"), [1, None]) == 0
    assert as_rows(table.rows()) == [(2, 2)]


ORDERS = (
    "order_id bigint, user_id bigint, eval_set string, order_number int, order_dow int, "
    "order_hour_of_day int, days_since_prior_order double"
)


def test_one_weekday_is_run_again(spark, tmp_path):
    rows = [(i, i % 9, "prior", 1, i % 7, 5, None) for i in range(200)] + [(900, 1, "prior", 1, None, 5, None)]
    table = merging.orders_by_weekday(spark, f"{tmp_path}/orders")
    table.replace(clean_orders(spark.createDataFrame(rows, ORDERS)), [None, *range(7)])
    before = files(table.path)
    corrected = [(*r[:5], 11, 2.0) for r in rows] + [(i, 3, "prior", 1, 3, 11, None) for i in (3, 400)]
    written = merging.rerun_weekdays(table, spark.createDataFrame(corrected, ORDERS), [3])
    assert written == len([r for r in rows if r[4] == 3]) + 1
    after = files(table.path)
    assert {f for f in before if f not in after} == {f for f in before if "order_dow=3/" in f}
    hours = {tuple(r) for r in table.rows().select("order_dow", "order_hour_of_day").collect()}
    assert hours == {(None, 5), (3, 11), *((d, 5) for d in (0, 1, 2, 4, 5, 6))}
    assert "PartitionFilters" in plan_of(table.rows([3]))
    # An order that moved to weekday 3 is still stored under its old one.
    moved = [(1, 2, "prior", 1, 3, 4, None)]
    with pytest.raises(merging.MovedOrders):
        merging.rerun_weekdays(table, spark.createDataFrame(moved, ORDERS), [3])
    assert files(table.path) == after
    assert merging.rerun_weekdays(table, spark.createDataFrame(moved, ORDERS), [1, 3]) == 1
    assert table.values_of(table.rows()) == [None, 0, 2, 3, 4, 5, 6]


# States --------------------------------------------------------------------------------


def test_distinct_states_merge_exactly(spark):
    rows = [("a", i % 70_000) for i in range(0, 200_000, 3)] + [("b", 5), ("b", 5), ("c", None), (None, 7)]
    frame = spark.createDataFrame(rows, "g string, k bigint")
    halves = [distinct_state(frame.where(f"k % 2 = {r}"), ["g"], "k") for r in (0, 1)]
    overlap = distinct_state(frame.where("k < 40000"), ["g"], "k")
    found = distinct_counts(merge_distinct([*halves, overlap], ["g"]), ["g"], "n")
    exact = frame.where("k IS NOT NULL").groupBy("g").agg(F.countDistinct("k").alias("n"))
    assert as_rows(found) == as_rows(exact)


def test_distinct_states_shuffle_bitmaps_only(spark):
    frame = spark.range(100_000).selectExpr("id % 3 AS g", "id AS k")
    plan = plan_of(distinct_counts(distinct_state(frame, ["g"], "k"), ["g"], "n"))
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and not any("_bit" in line or "k#" in line for line in shuffled)
    assert "partial_bitmap_construct_agg" in plan


def test_states_follow_drops(spark, tmp_path):
    labels = spark.createDataFrame(
        [(p, f"p{p}", p % 2, p % 3, f"d{p % 2}", f"a{p % 3}") for p in range(1, 6)],
        "product_id bigint, product_name string, department_id int, aisle_id int, department string, aisle string",
    )
    orders = spark.createDataFrame([(o, o % 7, o % 24) for o in range(0, 800, 5)] , "order_id bigint, order_dow int, order_hour_of_day int")
    table = merging.items_by_range(spark, f"{tmp_path}/items")
    state = BasketState(spark, f"{tmp_path}/state", table, SPAN)
    state.refresh(labels, orders, list(range(8)))
    for n, drop in enumerate(drops()):
        merged = state.take_in(items_of(spark, drop), labels, orders)
        assert merged.touched == [[0, 1, 2, 3], [1], [1, 3, 4, 5, 6, 7]][n]
        items = clean_items(items_of(spark, [r for d in drops()[: n + 1] for r in d]))
        totals = marts.product_totals(items)
        assert as_rows(state.totals()) == as_rows(totals)
        assert as_rows(state.department_kpis(labels)) == as_rows(marts.department_kpis(items, labels, totals))
        assert as_rows(state.aisle_reorder(labels)) == as_rows(marts.aisle_reorder(marts.aisle_rates(labels, totals)))
        baskets = marts.orders_with_baskets(orders, marts.order_baskets(items))
        assert as_rows(state.hourly_demand()) == as_rows(marts.hourly_demand(baskets))


@pytest.mark.parametrize("step", [5000, 1 << 50])
def test_drops_of_many_ids_have_a_number_of_ranges(spark, step):
    ids = spark.range(MOST_RANGES + 60).selectExpr(f"nullif(id, 7) * {step} AS order_id")
    span = _drop_span(ids.limit(40), ids)
    assert ids.select(merging.order_range(span)).distinct().count() <= MOST_RANGES + 1
    assert _drop_span(spark.range(9 * DROP_SPAN).toDF("order_id")) == DROP_SPAN


def test_merged_items_lie_in_a_number_of_ranges(spark, tmp_path):
    n = MOST_RANGES + 60
    spark.range(3 * n).selectExpr(
        f"id % {n} * 5000 AS l_orderkey", "id % 5 AS l_partkey", f"int(id / {n}) AS l_linenumber",
        "if(id % 3 = 0, 'R', 'N') AS l_returnflag", "if(id % 2 = 0, 'F', 'O') AS l_linestatus",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["merged_items"](spark, str(tmp_path))
    assert as_rows(found) == as_rows(QUERIES["clean_order_products"](spark, str(tmp_path)))
    items = Path(session_path(spark, "merged-items", str(tmp_path)))
    assert 1 < len([*items.glob("order_range=*")]) <= MOST_RANGES


# Sketches ------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [64, 1024])
def test_merged_sketches_keep_to_their_bound(spark, size):
    rows = spark.range(120_000).selectExpr("CAST(pow(id % 4999, 1.3) AS BIGINT) AS k")
    sketches = count_sketches(rows, "k", buckets=7, size=size)
    assert sketches.count() == 7
    found = sketched_skew(sketches).first()
    exact = key_skew(rows, "k").first()
    assert found.n_keys == rows.distinct().count() and found.max_rows == exact.max_rows
    error = rank_error(rows, "k", F.lit(found.median_rows)).first()
    assert error.median_rows == exact.median_rows
    assert 0 <= error.rank_error <= 2 * sketch_rank_error(size)


def test_one_bucket_is_replaced_alone(spark):
    rows = spark.range(900).selectExpr("id % 90 AS k")
    more = rows.unionByName(spark.range(500).selectExpr("7L AS k"))
    old, new = (count_sketches(r, "k", buckets=5) for r in (rows, more))
    changed = new.where("max_rows > 10").select("bucket").first()[0]
    mixed = old.where(f"bucket <> {changed}").unionByName(new.where(f"bucket = {changed}"))
    assert sketched_skew(mixed).first() == sketched_skew(new).first()
    assert sketched_skew(mixed).first().max_rows == 510


def test_rank_error_of_values_off_the_median(spark):
    rows = spark.range(55).selectExpr("CAST(sqrt(id * 2) AS INT) AS k")
    counts = sorted(r[0] for r in rows.groupBy("k").count().select("count").collect())
    for value in (0, counts[len(counts) // 2], 1000):
        error = rank_error(rows, "k", F.lit(value)).first().rank_error
        below, up_to = (sum(c < value for c in counts), sum(c <= value for c in counts))
        assert error == pytest.approx(max(0, below / len(counts) - 0.5, 0.5 - up_to / len(counts)))
