import pytest
from conftest import as_rows, plan_of

from basket_marts import schemas
from basket_marts.plans import quality
from basket_marts.session import BROADCAST_BYTES, ROWS_PER_SPLIT


@pytest.fixture
def broken(spark):
    items = spark.createDataFrame(
        [
            (None, 1, 1, 0),  # no order
            (1, None, 1, 0),  # no product: also an orphan
            (None, None, 1, 0),
            (None, None, 1, 0),  # NULL keys count as equal: one repeat
            (2, 1, 1, None),  # a missing flag passes the domain check
            (2, 2, 2, 2),  # bad flag
            (3, 1, 1, 1),
            (3, 1, 2, 1),
            (3, 1, 3, 1),  # two repeats
            (4, 50, 1, 1),  # unknown product
        ],
        schemas.ITEMS_SCHEMA,
    )
    orders = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "order_id INT")
    products = spark.createDataFrame(
        [(1, "a", 1, 1), (2, "b", 1, 1), (2, "b", 1, 1)], schemas.PRODUCTS_SCHEMA
    )
    return items, orders, products


def test_each_check_counts_its_violations(broken):
    report = quality.table_report(*broken)
    assert {r.check_name: r.violations for r in report.collect()} == {
        quality.ITEM_KEYS_PRESENT: 4,
        quality.ITEM_KEYS_UNIQUE: 3,
        quality.REORDERED_DOMAIN: 1,
        quality.PRODUCT_EXISTS: 4,
        quality.ORDER_ID_UNIQUE: 3,
    }
    assert not any(r.ok for r in report.collect())


def test_items_are_scanned_once_for_their_four_checks(spark, broken, tmp_path):
    items, _, products = broken
    items.write.parquet(f"{tmp_path}/items")
    stored = spark.read.parquet(f"{tmp_path}/items")
    assert plan_of(quality.item_checks(stored, products)).count("FileScan parquet") == 1


def test_empty_tables_have_no_violations(broken):
    report = quality.table_report(*(frame.where("false") for frame in broken))
    assert [r.ok for r in report.collect()] == [True] * 5


@pytest.mark.parametrize("limit", ["1000000", "0"])
def test_orphans_include_items_without_a_product(broken, conf, limit):
    conf(BROADCAST_BYTES, limit)
    conf(ROWS_PER_SPLIT, "1")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    items, _, products = broken
    orphans = quality.orphan_items(items, products)
    assert [(r[1], r[2]) for r in as_rows(orphans)] == [
        (None, None),
        (None, None),
        (1, None),
        (4, 50),
    ]


def _mart(spark, rates):
    return spark.createDataFrame(
        [(f"a{i}", 1, rate, None, None) for i, rate in enumerate(rates)],
        ", ".join(
            f"{c} {t}" for c, t in schemas.MART_CONTRACTS["mart_aisle_reorder"].columns.items()
        ),
    )


def test_rates_outside_zero_to_one(spark):
    mart = _mart(spark, [-0.1, 0.0, 1.0, 1.1, None, float("nan")])
    report = quality.mart_checks("mart_aisle_reorder", mart).collect()
    assert [(r.ok, r.violations) for r in report] == [(True, 0), (False, 3)]


def test_an_empty_mart_fails(spark):
    report = quality.mart_checks("mart_aisle_reorder", _mart(spark, [1.0]).where("false"))
    assert [(r.ok, r.violations) for r in report.collect()] == [(False, 1), (True, 0)]


def test_gate_names_every_failed_check(broken):
    with pytest.raises(quality.ContractViolation) as caught:
        quality.enforce(quality.table_report(*broken))
    assert len(caught.value.failed) == 5
    assert all(name in str(caught.value) for name in caught.value.failed)


def test_gate_lets_a_clean_report_pass(broken):
    report = quality.table_report(*(frame.where("false") for frame in broken))
    assert len(quality.enforce(report)) == 5
