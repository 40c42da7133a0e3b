from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basket_marts.operators.skew import heavy_keys
from basket_marts.session import broadcast_limit

_WORD = 8


def _value_bytes(field: T.StructField) -> Column | None:
    """Bytes of a value beyond its word in the row, for types that have any."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(column) + _WORD
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        # Every nested value has at least two characters here and at most two words there.
        return _WORD * F.octet_length(F.to_json(F.struct(column)))
    if isinstance(field.dataType, T.AtomicType):
        return None
    raise TypeError(f"cannot tell the size of {field.dataType.simpleString()}")


def measured_bytes(table: DataFrame) -> int:
    """Size of `table` as Spark holds its rows in memory, nested values from above: a null
    word and one word per column, plus the bytes of variable-length values. One small
    aggregate, one row back.
    """
    extra = [b for b in map(_value_bytes, table.schema.fields) if b is not None]
    row_bytes = F.lit(_WORD * (1 + len(table.columns))).cast("bigint")
    for value_bytes in extra:
        row_bytes = row_bytes + F.coalesce(value_bytes, F.lit(0))
    return table.agg(F.sum(row_bytes)).first()[0] or 0


def _sent_if_small(table: DataFrame) -> DataFrame:
    small = measured_bytes(table) <= broadcast_limit(table.sparkSession)
    return F.broadcast(table) if small else table


def dimension_join(
    rows: DataFrame, dimension: DataFrame, key: str, spread_by: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join many rows to a lookup table without shuffling them where that is safe.

    The lookup is broadcast only after its size has been measured against
    `spark.basketmarts.broadcastBytes`; a larger one goes through `salted_join`.
    """
    if measured_bytes(dimension) <= broadcast_limit(rows.sparkSession):
        return rows.join(F.broadcast(dimension), key, how)
    return salted_join(rows, dimension, key, spread_by, how)


def salted_join(
    rows: DataFrame, dimension: DataFrame, key: str, spread_by: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Sort-merge join that splits heavy keys over as many tasks as their rows need.

    Rows of a heavy key get a salt hashed from `spread_by` (so a re-run of a lost task
    places them alike); the matching dimension rows are repeated once per salt. Rows
    with a NULL key never match, and are spread as well. `how` is inner, left or left_anti.
    """
    spark = rows.sparkSession
    heavy = _sent_if_small(heavy_keys(rows, key))
    spread = F.xxhash64(*spread_by)
    null_splits = spark.conf.get("spark.sql.shuffle.partitions")
    salted_rows = rows.join(heavy, key, "left").withColumn(
        "salt",
        F.when(F.col(key).isNull(), F.pmod(spread, F.lit(int(null_splits))))
        .otherwise(F.pmod(spread, F.coalesce("splits", F.lit(1))))
        .cast("int"),
    )
    salted_dimension = dimension.join(heavy, key, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1))
    )
    joined = salted_rows.drop("splits").join(
        salted_dimension.drop("splits").hint("merge"), [key, "salt"], how
    )
    return joined.drop("salt")
