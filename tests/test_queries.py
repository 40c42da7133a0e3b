"""Every registered query against its SQL, on the shared tables."""

import re

import duckdb
import pytest
from conftest import _sort_key, as_rows, plan_of

import __spark_entry__ as entry
from basket_marts.oracle import ORACLE
from basket_marts.queries import QUERIES
from basket_marts.session import BROADCAST_BYTES, ROWS_PER_SPLIT

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in ("lineitem", "orders", "part"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) == 48
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert result.columns[0] == "department" and result.count() > 0


def _compare(spark, duck, folder, name):
    frame = QUERIES[name](spark, folder)
    expected = duck.execute(ORACLE[name])
    described = {column[0]: str(column[1]) for column in expected.description}
    assert {c: TYPES[t] for c, t in frame.dtypes} == described

    positions = [list(described).index(c) for c in sorted(described)]
    rows = [tuple(row[i] for i in positions) for row in expected.fetchall()]
    assert as_rows(frame) == sorted(rows, key=_sort_key)
    assert rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, folder, name):
    _compare(spark, duck, folder, name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_as_for_large_tables(spark, duck, folder, name, conf):
    """Nothing is small enough to broadcast, and most keys are too large for one task."""
    conf(ROWS_PER_SPLIT, "4")
    conf(BROADCAST_BYTES, "0")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    _compare(spark, duck, folder, name)


@pytest.mark.parametrize(
    "name, present, absent",
    [
        ("enrich_items", "BroadcastHashJoin", "SortMergeJoin"),
        ("join_broadcast", "BroadcastHashJoin", "SortMergeJoin"),
        ("join_shuffle", "SortMergeJoin", "BroadcastHashJoin"),
        ("mart_product_rank", "WindowGroupLimit", "NestedLoop"),
        ("mart_aisle_reorder", "ReusedExchange", "NestedLoop"),
    ],
)
def test_query_runs_the_plan_it_should(spark, folder, name, present, absent):
    plan = plan_of(QUERIES[name](spark, folder))
    assert present in plan and absent not in plan
    assert "CartesianProduct" not in plan and "Python" not in plan


def test_scans_read_only_the_columns_they_need(spark, folder):
    plan = plan_of(QUERIES["key_skew"](spark, folder))
    assert "FileScan parquet [l_orderkey#" in plan and "l_returnflag" not in plan


@pytest.mark.parametrize("name", ["mart_product_rank", "enrich_items"])
def test_products_are_not_shuffled_by_department_or_aisle(spark, folder, name, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(QUERIES[name](spark, folder))
    assert not re.search(r"SortMergeJoin \[(department|aisle)_id", plan)
    assert re.search(r"BroadcastHashJoin \[(department|aisle)_id", plan)
