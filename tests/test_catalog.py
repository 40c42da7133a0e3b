"""Versioned marts in the catalog, and tables whose join needs no shuffle."""

import pytest
from conftest import as_rows, plan_of
from pyspark.sql import functions as F

from basket_marts.plans import marts
from basket_marts.plans.colocated import ColocatedTables
from basket_marts.schemas import MART_CONTRACTS
from basket_marts.session import ROWS_PER_SPLIT
from basket_marts.sinks import publish_mart, to_catalog
from basket_marts.sinks.publish import CatalogTables, PublishError

NAME = "mart_product_rank"
CONTRACT = MART_CONTRACTS[NAME]


@pytest.fixture
def mart(spark):
    rows = [(3, 1, "x", "b"), (2, 2, "y", "b"), (9, 1, "z", "a")]
    return spark.createDataFrame(rows, "n_items INT, rnk BIGINT, product_name STRING, department STRING")


@pytest.fixture(params=[False, True])
def writer(spark, tmp_path, request):
    yield to_catalog("basket_versions", str(tmp_path) if request.param else None)
    spark.sql("DROP DATABASE IF EXISTS basket_versions CASCADE")


def shown(spark):
    return as_rows(spark.table(f"basket_versions.{NAME}"))


def test_a_mart_is_a_view_of_its_newest_version(spark, mart, writer):
    names = []
    for n in (3, 2, 1):
        assert publish_mart(mart.limit(n), NAME, CONTRACT, writer) == n
        assert len(shown(spark)) == n
        names.append(writer.current(spark, NAME))
    # The one before the newest is still there for those who read it.
    assert writer.versions(spark, NAME) == names[1:]
    assert spark.table(f"basket_versions.{names[1]}").count() == 2
    properties = writer.properties(spark, names[-1])
    assert properties[CatalogTables.SORTED_BY] == "department, rnk"
    assert properties[CatalogTables.COLUMNS] == ", ".join(f"{c} {t}" for c, t in CONTRACT.columns.items())
    assert dict(spark.table(f"basket_versions.{NAME}").dtypes) == CONTRACT.columns


@pytest.mark.parametrize("step", ["_write", "_show"])
def test_whatever_step_breaks_the_old_version_stays(spark, mart, writer, monkeypatch, step):
    publish_mart(mart, NAME, CONTRACT, writer)
    before, versions = shown(spark), writer.versions(spark, NAME)
    whole = getattr(CatalogTables, step)

    def broken(self, rows, *args):
        if step == "_write":
            whole(self, rows, *args)  # all written, then lost
        raise OSError("lost")

    monkeypatch.setattr(CatalogTables, step, broken)
    with pytest.raises(OSError):
        publish_mart(mart.limit(1), NAME, CONTRACT, writer)
    assert shown(spark) == before and writer.versions(spark, NAME) == versions
    monkeypatch.undo()
    publish_mart(mart.limit(1), NAME, CONTRACT, writer)
    assert len(shown(spark)) == 1


def test_a_refused_mart_changes_nothing(spark, mart, writer):
    publish_mart(mart, NAME, CONTRACT, writer)
    before = shown(spark)
    with pytest.raises(PublishError):
        publish_mart(mart.withColumn("rnk", F.lit(None).cast("bigint")), NAME, CONTRACT, writer)
    assert shown(spark) == before


def test_a_plain_table_becomes_the_oldest_version(spark, mart, writer):
    spark.sql("CREATE DATABASE IF NOT EXISTS basket_versions")
    mart.write.saveAsTable(f"basket_versions.{NAME}")
    publish_mart(mart.limit(1), NAME, CONTRACT, writer)
    assert len(shown(spark)) == 1
    assert spark.table(f"basket_versions.{writer.versions(spark, NAME)[0]}").count() == 3


# Co-located tables ----------------------------------------------------------------------


@pytest.fixture
def stored(spark, tmp_path):
    yield ColocatedTables(spark, "basket_buckets", f"{tmp_path}/tables", 4)
    spark.sql("DROP DATABASE IF EXISTS basket_buckets CASCADE")


def tables(spark, heavy):
    rows = [(o, p, p % 2 if p else None) for o in range(1, 60) for p in range(o % 9)]
    rows += [(1000, p, int(p % 3 == 0)) for p in range(heavy)]
    items = spark.createDataFrame(rows, "order_id bigint, product_id bigint, reordered int")
    orders = spark.createDataFrame([(o, o % 7) for o in [*range(1, 70), 1000]], "order_id bigint, order_dow int")
    return items, orders


def test_baskets_and_their_orders_meet_without_a_shuffle(spark, stored, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    items, orders = tables(spark, 40)
    stored.write(items, orders)
    found = stored.orders_with_baskets()
    assert as_rows(found) == as_rows(marts.orders_with_baskets(orders, marts.order_baskets(items)))
    plan = plan_of(found)
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_a_dominant_order_lies_in_several_buckets(spark, stored, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf(ROWS_PER_SPLIT, "100")
    items, orders = tables(spark, 1000)
    stored.write(items, orders)
    salts = stored.table("items").where("order_id = 1000").groupBy("salt").count().collect()
    assert len(salts) == 10 and max(r["count"] for r in salts) < 200
    found = stored.orders_with_baskets()
    assert as_rows(found) == as_rows(marts.orders_with_baskets(orders, marts.order_baskets(items)))
    # Only the partial baskets of the one order move.
    (exchange,) = [line for line in plan_of(found).splitlines() if "Exchange hashpartitioning" in line]
    assert "order_id" in exchange
    # Writing again replaces the tables.
    stored.write(*tables(spark, 3))
    assert stored.table("heavy_orders").isEmpty() and stored.orders_with_baskets().count() == 70
