import random

import pytest
from conftest import as_rows, plan_of
from pyspark.sql import functions as F

from basket_marts.operators import (
    dimension_join,
    heavy_keys,
    key_skew,
    least_row_per_key,
    least_tagged_pair_per_key,
    measured_bytes,
    salted_join,
    standardise,
    top_n_per_group,
)
from basket_marts.session import BROADCAST_BYTES, ROWS_PER_SPLIT


def test_least_row_ranks_null_lowest_and_ignores_row_order(spark):
    rows = [(1, 2, "b"), (1, None, "z"), (1, 1, "a"), (2, 5, "c"), (2, 5, "b")]
    for ordered in (rows, rows[::-1]):
        frame = spark.createDataFrame(ordered, "k INT, x INT, y STRING").repartition(3)
        assert as_rows(least_row_per_key(frame, ["k"])) == [(1, None, "z"), (2, 5, "b")]


def test_copies_are_combined_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(least_row_per_key(frame, ["k"]))
    exchange = plan.index("Exchange")
    assert "partial_min" in plan[exchange:] and plan.count("Exchange hashpartitioning") == 1


def test_least_tagged_pair_keeps_the_same_row_as_the_struct_minimum(spark):
    edge = [-(2**31), -1, 0, 1, 2, 2**31 - 1]
    pick = random.Random(7).choice
    rows = [
        (pick(range(150)), pick("ab"), pick([None, *edge]), pick(edge)) for _ in range(1000)
    ] + [(500, "b", None, 2**31 - 1), (501, "a", -(2**31), -(2**31))]
    frame = spark.createDataFrame(rows, "k INT, tag STRING, x INT, y INT").repartition(5)
    kept = least_tagged_pair_per_key(frame, ["k"], "tag", ["a", "b"], "x", "y")
    assert kept.columns == frame.columns
    assert as_rows(kept) == as_rows(least_row_per_key(frame, ["k"]))
    assert "SortAggregate" not in plan_of(kept)


def test_least_tagged_pair_refuses_unlisted_tags(spark):
    frame = spark.createDataFrame([(1, "c", 1, 1)], "k INT, tag STRING, x INT, y INT")
    with pytest.raises(Exception, match="tag is none of a, b"):
        least_tagged_pair_per_key(frame, ["k"], "tag", ["a", "b"], "x", "y").collect()


@pytest.fixture
def skewed(spark):
    """One key in a third of the rows, NULL keys in another third."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 40)
    return spark.range(3000).select(
        F.col("id").alias("row"), key.cast("bigint").alias("k"), F.col("id").alias("measure")
    )


@pytest.fixture
def lookup(spark):
    return spark.range(1, 30).select(
        F.col("id").alias("k"), F.concat(F.lit("name "), F.col("id")).alias("name")
    )


def test_heavy_keys_need_several_tasks(spark, skewed, conf):
    conf(ROWS_PER_SPLIT, "100")
    n = skewed.where("k = 1").count()
    assert as_rows(heavy_keys(skewed, "k")) == [(1, -(-n // 100))]
    conf(ROWS_PER_SPLIT, "100000")
    assert heavy_keys(skewed, "k").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_salted_join_equals_plain_join(spark, skewed, lookup, conf, how):
    conf(ROWS_PER_SPLIT, "50")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    salted = salted_join(skewed, lookup, "k", ["row"], how)
    plain = skewed.join(lookup, "k", how)
    assert salted.columns == plain.columns
    assert as_rows(salted) == as_rows(plain)
    assert "SortMergeJoin" in plan_of(salted)


def test_salted_join_repeats_matches_of_repeated_lookup_keys(spark, skewed, lookup, conf):
    conf(ROWS_PER_SPLIT, "50")
    twice = lookup.unionByName(lookup)
    salted = salted_join(skewed, twice, "k", ["row"])
    assert as_rows(salted) == as_rows(skewed.join(twice, "k"))


def test_salted_join_spreads_the_dominant_key(spark, skewed, lookup, conf):
    conf(ROWS_PER_SPLIT, "50")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    joined = salted_join(skewed, lookup, "k", ["row"]).where("k = 1")
    per_task = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < joined.count() / 3


def test_lookup_is_broadcast_only_within_the_limit(spark, skewed, lookup, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    size = measured_bytes(lookup)
    conf(BROADCAST_BYTES, str(size))
    within = dimension_join(skewed, lookup, "k", ["row"])
    assert "BroadcastHashJoin" in plan_of(within) and "SortMergeJoin" not in plan_of(within)
    conf(BROADCAST_BYTES, str(size - 1))
    beyond = dimension_join(skewed, lookup, "k", ["row"])
    assert "SortMergeJoin" in plan_of(beyond)
    assert as_rows(within) == as_rows(beyond)


def test_measured_bytes_counts_words_and_text(spark):
    frame = spark.createDataFrame([(1, "abc"), (2, None)], "k BIGINT, t STRING")
    assert measured_bytes(frame) == 2 * 8 * 3 + (3 + 8)
    assert measured_bytes(frame.where("k > 9")) == 0


def test_top_n_prunes_before_the_shuffle_and_breaks_ties(spark):
    names = [("d", f"p{i:02d}", 5) for i in range(11)] + [("e", "x", 1)]
    frame = spark.createDataFrame(names, "department STRING, product_name STRING, n BIGINT")
    top = top_n_per_group(frame, "department", [F.desc("n"), F.col("product_name")], 10)
    kept = top.where("department = 'd'").orderBy("rnk").collect()
    assert [r.product_name for r in kept] == [f"p{i:02d}" for i in range(10)]
    assert [r.rnk for r in kept] == list(range(1, 11))
    plan = plan_of(top)
    assert "WindowGroupLimit" in plan[plan.index("Exchange") :]


def _rates(spark, values):
    return spark.createDataFrame(
        [(f"a{i}", v) for i, v in enumerate(values)], "aisle STRING, reorder_rate DOUBLE"
    )


@pytest.mark.parametrize("values", [[0.5, 0.5, 0.5], [0.5]])
def test_zscore_without_deviation_is_null(spark, values):
    scored = standardise(_rates(spark, values), "reorder_rate", 3, 2).collect()
    assert all(r.zscore is None and r.is_anomaly is None for r in scored)


def test_zscore_flags_the_outlier(spark):
    scored = standardise(_rates(spark, [0.5] * 9 + [0.9]), "reorder_rate", 3, 2)
    assert [r.aisle for r in scored.collect() if r.is_anomaly] == ["a9"]
    assert scored.where("aisle = 'a9'").first().zscore == 2.846
    plan = plan_of(scored)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_zscore_is_rounded_before_the_test(spark):
    # z of +-2 is 1.095: above 1 as it is, not above 1 once rounded to a whole number.
    scored = standardise(_rates(spark, [-1.0, 1.0, -2.0, 2.0]), "reorder_rate", 0, 1).collect()
    assert [(r.zscore, r.is_anomaly) for r in scored] == [
        (-1.0, 0),
        (1.0, 0),
        (-1.0, 0),
        (1.0, 0),
    ]


def test_key_skew(spark):
    keys = [(1,)] * 7 + [(2,)] * 2 + [(3,)] * 2
    measured = key_skew(spark.createDataFrame(keys, "k INT"), "k").first()
    assert tuple(measured) == (7, 2, 3.5)
    assert tuple(key_skew(spark.createDataFrame([], "k INT"), "k").first()) == (None, None, None)


def test_pairs_wider_than_int_keep_a_row_that_exists(spark):
    rows = spark.createDataFrame(
        [(1, "a", 2**33, 0), (1, "a", 5, 1), (1, "b", 0, 0)], "k INT, tag STRING, p BIGINT, q INT"
    )
    kept = least_tagged_pair_per_key(rows, ["k"], "tag", ["a", "b"], "p", "q")
    assert as_rows(kept) == [(1, 5, 1, "a")]


def test_nested_columns_count_towards_the_size(spark):
    table = spark.range(1).selectExpr("id", "sequence(1, 10000) AS numbers")
    assert measured_bytes(table) > 80_000
    assert measured_bytes(spark.range(10)) == 10 * 16
