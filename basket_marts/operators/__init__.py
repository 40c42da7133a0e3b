"""Reusable DataFrame-to-DataFrame operators."""

from basket_marts.operators.dedup import least_row_per_key, least_tagged_pair_per_key
from basket_marts.operators.distinct import distinct_counts, distinct_state, merge_distinct
from basket_marts.operators.joins import dimension_join, measured_bytes, salted_join
from basket_marts.operators.outliers import standardise
from basket_marts.operators.ranking import top_n_per_group
from basket_marts.operators.skew import (
    count_sketches,
    heavy_keys,
    key_skew,
    rank_error,
    sketch_rank_error,
    sketched_skew,
)

__all__ = [
    "count_sketches",
    "dimension_join",
    "distinct_counts",
    "distinct_state",
    "heavy_keys",
    "key_skew",
    "least_row_per_key",
    "least_tagged_pair_per_key",
    "measured_bytes",
    "merge_distinct",
    "rank_error",
    "salted_join",
    "sketch_rank_error",
    "sketched_skew",
    "standardise",
    "top_n_per_group",
]
