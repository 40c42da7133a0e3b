"""Raw tables -> key-complete, deduplicated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket_marts.functions import none_null
from basket_marts.operators import least_row_per_key, least_tagged_pair_per_key
from basket_marts.schemas import ITEM_KEYS, ORDER_KEYS, PRIOR, SPLITS, TRAIN


def clean_dimension(raw: DataFrame, key: str) -> DataFrame:
    return least_row_per_key(raw.where(none_null(key)), [key])


def clean_orders(raw: DataFrame) -> DataFrame:
    return least_row_per_key(raw.where(none_null(*ORDER_KEYS)), ["order_id"])


def tagged_items(prior: DataFrame, train: DataFrame) -> DataFrame:
    """Both splits as one table, each row tagged with the split it came from."""
    return prior.withColumn("eval_set", F.lit(PRIOR)).unionByName(
        train.withColumn("eval_set", F.lit(TRAIN))
    )


def clean_items(tagged: DataFrame) -> DataFrame:
    """Of copies of a key the earlier split survives, then the lower position, then flag."""
    items = tagged.where(none_null(*ITEM_KEYS)).withColumn(
        "reordered", F.coalesce("reordered", F.lit(0))
    )
    return least_tagged_pair_per_key(
        items, ITEM_KEYS, "eval_set", SPLITS, "add_to_cart_order", "reordered"
    )


def clean_order_products(prior: DataFrame, train: DataFrame) -> DataFrame:
    return clean_items(tagged_items(prior, train))
