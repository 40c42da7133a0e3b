"""Typed, sorted, repeatable publishing of marts."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basket_marts.schemas import MART_CONTRACTS, MartContract
from basket_marts.session import remove_folder, replace_folder, scratch_path

Writer = Callable[[DataFrame, str], None]


class PublishError(Exception):
    """A mart breaks its published contract. The published table was not touched."""


def conform(mart: DataFrame, contract: MartContract) -> DataFrame:
    """Contract columns in contract order and type, in stored order.

    `orderBy` range-partitions: a small mart becomes one sorted file, a large one
    several files whose ranges do not overlap.
    """
    typed = mart.select(*(F.col(c).cast(t).alias(c) for c, t in contract.columns.items()))
    return typed.orderBy(*contract.sort_by)


class ParquetFolder:
    """Published marts as folders below one root. A mart is staged beside its place and
    moved there when it is whole.
    """

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def staging_path(self, name: str) -> str:
        return f"{self.root}/.staged-{name}-{uuid.uuid4().hex}"

    def put(self, spark: SparkSession, staged: str, name: str) -> None:
        replace_folder(spark, staged, f"{self.root}/{name}")

    def __call__(self, rows: DataFrame, name: str) -> None:
        staged = self.staging_path(name)
        rows.write.parquet(staged)
        self.put(rows.sparkSession, staged, name)


def to_parquet(root: str) -> Writer:
    return ParquetFolder(root)


class CatalogTables:
    """Published marts as views of one database, each over the newest version of its table.

    A mart is written as a table of its own, with its contract and stored order as properties.
    Replacing the view is then one change in the catalog: readers see the old mart or the new
    one, and whatever fails before leaves the old one readable. The version before the newest
    stays, for readers that have begun; older ones are dropped. A plain table of the mart's
    name, as earlier releases left it, becomes the oldest version.
    """

    COLUMNS, SORTED_BY, VERSION = (f"basketmarts.{p}" for p in ("columns", "sortedBy", "version"))

    def __init__(self, database: str, location: str | None = None):
        self.database, self.location = database, location

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def versions(self, spark: SparkSession, name: str) -> list[str]:
        """Tables that hold versions of a mart, oldest first."""
        found = spark.sql(f"SHOW TABLES IN `{self.database}` LIKE '{name}__v*'").collect()
        return sorted(row.tableName for row in found)

    def properties(self, spark: SparkSession, table: str) -> dict[str, str]:
        rows = spark.sql(f"SHOW TBLPROPERTIES {self._name(table)}").collect()
        return {row.key: row.value for row in rows}

    def current(self, spark: SparkSession, name: str) -> str | None:
        """The table that a mart's view shows."""
        if not spark.catalog.tableExists(f"{self.database}.{name}"):
            return None
        return self.properties(spark, name).get(self.VERSION)

    def _write(self, rows: DataFrame, name: str, version: str) -> None:
        spark = rows.sparkSession
        target = rows.write.format("parquet")
        if self.location:
            target = target.option("path", f"{self.location}/{version}")
        target.saveAsTable(self._name(version))
        contract = MART_CONTRACTS.get(name)
        columns = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
        sorted_by = ", ".join(contract.sort_by) if contract else ""
        spark.sql(
            f"ALTER TABLE {self._name(version)} SET TBLPROPERTIES "
            f"('{self.COLUMNS}' = '{columns}', '{self.SORTED_BY}' = '{sorted_by}')"
        )

    def _show(self, spark: SparkSession, name: str, version: str) -> None:
        """The one step that publishes."""
        spark.sql(
            f"CREATE OR REPLACE VIEW {self._name(name)} "
            f"TBLPROPERTIES ('{self.VERSION}' = '{version}') AS SELECT * FROM {self._name(version)}"
        )

    def _drop(self, spark: SparkSession, version: str) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {self._name(version)}")
        if self.location:
            remove_folder(spark, f"{self.location}/{version}")

    def __call__(self, rows: DataFrame, name: str) -> None:
        spark = rows.sparkSession
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        before = self.current(spark, name)
        if before is None and spark.catalog.tableExists(f"{self.database}.{name}"):
            before = f"{name}__v0"
            spark.sql(f"ALTER TABLE {self._name(name)} RENAME TO {self._name(before)}")
        version = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
        try:
            self._write(rows, name, version)
            self._show(spark, name, version)
        except BaseException:
            if self.current(spark, name) != version:
                self._drop(spark, version)
            raise
        for old in self.versions(spark, name):
            if old not in (before, version):
                self._drop(spark, old)


def to_catalog(database: str, location: str | None = None) -> Writer:
    """Versions are external tables below `location`, or managed ones without it."""
    return CatalogTables(database, location)


def to_jdbc(url: str, **options: str) -> Writer:
    """Truncate and refill a database table, keeping its own column types and keys."""

    def write(rows: DataFrame, name: str) -> None:
        target = rows.write.format("jdbc").options(url=url, dbtable=name, truncate="true")
        target.options(**options).mode("overwrite").save()

    return write


def publish_mart(mart: DataFrame, name: str, contract: MartContract, writer: Writer) -> int:
    """Stage the typed, sorted mart, check it in the same pass, then replace the published
    one. Returns the number of rows.

    Work and checks happen while staging, so a failure there leaves the published mart as it
    was. Below a `ParquetFolder` the staged folder itself is moved into place: one sort, one
    write. Other writers read it once more. Nothing staged is left behind.
    """
    spark = mart.sparkSession
    is_folder = isinstance(writer, ParquetFolder)
    staged = writer.staging_path(name) if is_folder else scratch_path(spark, f"staged-{name}")
    observed = Observation()
    checks = [F.count(F.lit(1)).alias("rows")]
    checks += [F.count_if(F.col(c).isNull()).alias(f"{c} is NULL") for c in contract.columns]
    checks += [F.count_if(F.col(c) < 0).alias(f"{c} is negative") for c in contract.unsigned]
    try:
        conform(mart, contract).observe(observed, *checks).write.parquet(staged)
        counts = dict(observed.get)
        n_rows = counts.pop("rows")
        broken = {check: n for check, n in counts.items() if n}
        if broken:
            raise PublishError(f"{name}: {broken}")
        if is_folder:
            writer.put(spark, staged, name)
        else:
            rows = spark.read.schema(_ddl(contract)).parquet(staged)
            writer(rows.orderBy(*contract.sort_by), name)
    finally:
        remove_folder(spark, staged)
    return n_rows


def _ddl(contract: MartContract) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in contract.columns.items())
