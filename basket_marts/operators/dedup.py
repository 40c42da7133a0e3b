from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def least_row_per_key(
    rows: DataFrame, keys: Sequence[str], survivor_order: Sequence[str] | None = None
) -> DataFrame:
    """Keep one row per key: the least over the other columns, NULL ranking lowest.

    `min` combines copies before the shuffle, so a key with very many copies sends one
    row per map task, and the survivor does not depend on how rows are partitioned.
    """
    others = survivor_order or [c for c in rows.columns if c not in keys]
    kept = rows.groupBy(*keys).agg(F.min(F.struct(*others)).alias("kept"))
    return kept.select(*(c if c in keys else f"kept.{c}" for c in rows.columns))


def least_tagged_pair_per_key(
    rows: DataFrame, keys: Sequence[str], tag: str, tags: Sequence[str], first: str, second: str
) -> DataFrame:
    """The survivor `least_row_per_key` would keep by (tag, first, second), found by hashing.

    A minimum over a struct can only be aggregated by sorting. Here every tag value has
    minima of its own over bigints: of both columns packed into one that sorts as the
    pair, and of `second` alone for rows whose `first` is NULL. `tags` lists all values
    in ascending order; `second` is never NULL. Where a column is wider than INT, the pair
    does not fit a bigint and the survivor is found by sorting after all.
    """
    narrow = {"tinyint", "smallint", "int"}
    types = dict(rows.dtypes)
    if not {types[first], types[second]} <= narrow:
        return least_row_per_key(rows, keys, [tag, first, second])
    # The low half is shifted to 0 .. 2^32 - 1, so that it sorts as the unsigned half it is.
    packed = f"(shiftleft(CAST({first} AS BIGINT), 32) | ({second} + {2**31}L))"
    low_half = f"CAST((%s & {2**32 - 1}L) - {2**31}L AS INT)"
    row = f"named_struct('{tag}', '%s', '{first}', CAST(%s AS INT), '{second}', %s)"
    minima, candidates = [], []
    for position, value in enumerate(tags):
        alone, pair = f"alone_{position}", f"pair_{position}"
        is_alone = f"{tag} = '{value}' AND {first} IS NULL"
        minima += [
            F.expr(f"min(CASE WHEN {is_alone} THEN {second} END) AS {alone}"),
            F.expr(f"min(CASE WHEN {tag} = '{value}' THEN {packed} END) AS {pair}"),
        ]
        as_alone = row % (value, "NULL", alone)
        as_pair = row % (value, f"shiftright({pair}, 32)", low_half % pair)
        candidates += [f"WHEN {alone} IS NOT NULL THEN {as_alone}"]
        candidates += [f"WHEN {pair} IS NOT NULL THEN {as_pair}"]
    unknown = f"raise_error('{tag} is none of {', '.join(tags)}, or {second} is NULL')"
    kept = F.expr(f"CASE {' '.join(candidates)} ELSE {unknown} END AS kept")
    least = rows.groupBy(*keys).agg(*minima).select(*keys, kept)
    return least.select(*(c if c in keys else f"kept.{c}" for c in rows.columns))
