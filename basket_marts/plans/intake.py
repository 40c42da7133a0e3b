"""Cleaning that accounts for every raw row: kept, a copy of a kept one, or rejected."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basket_marts.functions import any_null
from basket_marts.session import empty_stages_kept
from basket_marts.sources.raw_files import FILE, RECORD

MISSING_KEY, MALFORMED = "missing key", "malformed record"

REJECTS_SCHEMA = "table_name string, reason string, file string, record string"
ACCOUNTS_SCHEMA = (
    "table_name string, rows_read bigint, kept bigint, duplicates bigint, rejected bigint, "
    "damaged bigint"
)


@dataclass(frozen=True)
class Account:
    """Where the rows of a raw table went.

    `damaged` rows are in the table although their record does not fit the schema: their keys
    could be read, other cells are NULL or were cut off.
    """

    table_name: str
    rows_read: int
    kept: int
    duplicates: int
    rejected: int
    damaged: int


def rejection(keys: Sequence[str]) -> Column:
    """Why an audited row cannot become a table row, or NULL if it can."""
    reason = F.when(F.col(RECORD).isNull(), MISSING_KEY).otherwise(MALFORMED)
    return F.when(any_null(*keys), reason)


def rejected_rows(raw: DataFrame, table_name: str, keys: Sequence[str]) -> DataFrame:
    """(table_name, reason, file, record) of the audited rows that cleaning leaves out.

    A sound record whose key is empty is written out again from its cells.
    """
    cells = F.to_csv(F.struct(*raw.columns[: raw.columns.index(RECORD)]))
    reason = rejection(keys)
    return raw.where(reason.isNotNull()).select(
        F.lit(table_name).alias("table_name"),
        reason.alias("reason"),
        F.col(FILE).alias("file"),
        F.coalesce(RECORD, cells).alias("record"),
    )


def take_in(
    raw: DataFrame,
    table_name: str,
    keys: Sequence[str],
    clean: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], int],
    rejects_path: str,
) -> Account:
    """Clean an audited raw table, write it, and write what was rejected.

    The counts are observed in the pass that cleans, together with the files that hold rejected
    rows; only these files are read once more, and none if nothing was rejected. What an
    earlier run left at `rejects_path` is replaced.
    """
    observed = Observation()
    reason = rejection(keys)
    counted = raw.observe(
        observed,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(reason.isNotNull()).alias("rejected"),
        F.count_if(reason.isNull() & F.col(RECORD).isNotNull()).alias("damaged"),
        F.collect_set(F.when(reason.isNotNull(), F.col(FILE))).alias("files"),
    )
    with empty_stages_kept(raw.sparkSession):
        kept = write(clean(counted.drop(RECORD, FILE)))
    found = observed.get
    rejects = rejected_rows(raw.where(F.col(FILE).isin(list(found["files"]))), table_name, keys)
    if not found["rejected"]:
        rejects = raw.sparkSession.createDataFrame([], REJECTS_SCHEMA)
    rejects.write.mode("overwrite").parquet(rejects_path)
    return Account(
        table_name,
        found["rows_read"],
        kept,
        found["rows_read"] - found["rejected"] - kept,
        found["rejected"],
        found["damaged"],
    )


def accounts_frame(spark: SparkSession, accounts: Sequence[Account]) -> DataFrame:
    """One row per table; a handful, whatever the size of the tables."""
    columns = [part.split()[0] for part in ACCOUNTS_SCHEMA.split(", ")]
    rows = [tuple(asdict(account)[c] for c in columns) for account in accounts]
    return spark.createDataFrame(rows, ACCOUNTS_SCHEMA)
