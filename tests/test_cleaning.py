from conftest import as_rows

from basket_marts import schemas
from basket_marts.plans.cleaning import (
    clean_dimension,
    clean_items,
    clean_order_products,
    clean_orders,
    tagged_items,
)


def _items(spark, rows):
    return spark.createDataFrame(rows, schemas.ITEMS_SCHEMA)


def test_items_without_a_key_are_dropped(spark):
    prior = _items(spark, [(None, 1, 1, 0), (1, None, 1, 0), (1, 1, 1, 0), (None, None, 1, 1)])
    assert as_rows(clean_order_products(prior, _items(spark, []))) == [(1, "prior", 1, 1, 0)]


def test_missing_flag_becomes_zero_and_others_stay(spark):
    prior = _items(spark, [(1, 1, 1, None), (1, 2, 2, 0), (1, 3, 3, 1), (1, 4, 4, 2)])
    cleaned = clean_order_products(prior, _items(spark, [])).orderBy("product_id")
    assert [r.reordered for r in cleaned.collect()] == [0, 0, 1, 2]


def test_key_in_both_splits_keeps_the_prior_row(spark):
    prior, train = _items(spark, [(1, 1, 9, 1)]), _items(spark, [(1, 1, 2, 0), (2, 1, 5, 1)])
    cleaned = clean_order_products(prior, train)
    assert cleaned.columns == [
        "order_id",
        "product_id",
        "add_to_cart_order",
        "reordered",
        "eval_set",
    ]
    assert sorted(map(tuple, cleaned.collect())) == [(1, 1, 9, 1, "prior"), (2, 1, 5, 1, "train")]


def test_copies_within_a_split_keep_the_first_position_then_the_lower_flag(spark):
    prior = _items(spark, [(1, 1, 3, 0), (1, 1, 2, 1), (1, 1, 2, None)])
    cleaned = clean_items(tagged_items(prior, _items(spark, [])))
    assert [tuple(r) for r in cleaned.collect()] == [(1, 1, 2, 0, "prior")]


def test_orders_need_both_keys_and_keep_one_row_each(spark):
    orders = spark.createDataFrame(
        [
            (1, 5, "prior", 2, 0, 9, 3.0),
            (1, 5, "prior", 2, 0, 8, 3.0),
            (2, None, "prior", 1, 0, 9, None),
            (None, 5, "prior", 1, 0, 9, None),
            (3, 6, "train", 1, 6, 23, 7.0),
            (3, 6, "train", 1, 6, 23, None),
        ],
        schemas.ORDERS_SCHEMA,
    )
    assert sorted(map(tuple, clean_orders(orders).collect())) == [
        (1, 5, "prior", 2, 0, 8, 3.0),
        (3, 6, "train", 1, 6, 23, None),
    ]


def test_dimension_keeps_one_row_per_key(spark):
    aisles = spark.createDataFrame(
        [(1, "b"), (1, "a"), (None, "c"), (None, None), (2, None)], schemas.AISLES_SCHEMA
    )
    assert sorted(map(tuple, clean_dimension(aisles, "aisle_id").collect())) == [
        (1, "a"),
        (2, None),
    ]
