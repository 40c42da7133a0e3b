from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Lake:
    """Cleaned tables and marts as Parquet folders below one root."""

    spark: SparkSession
    root: str

    def table_path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def mart_path(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    def rejects_path(self, name: str) -> str:
        return f"{self.root}/rejects/{name}"

    def accounts_path(self) -> str:
        return f"{self.root}/accounts"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.table_path(name))

    def mart(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.mart_path(name))

    def rejects(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.rejects_path(name))

    def accounts(self) -> DataFrame:
        return self.spark.read.parquet(self.accounts_path())
