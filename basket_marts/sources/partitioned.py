"""A Parquet table in partition folders, of which some can be read or replaced alone."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basket_marts.session import folder_exists, remove_folder


@dataclass(frozen=True)
class PartitionedTable:
    """`schema` is the DDL of the rows without the partition column, an integer one.

    A partition is a folder of files; rows of a large one are in several. Values are listed on
    the driver, so there should be thousands of partitions at most.
    """

    spark: SparkSession
    path: str
    schema: str
    partition: str
    partition_type: str = "BIGINT"

    def rows(self, values: Sequence | None = None) -> DataFrame:
        """All rows, or those of some partitions: other folders are then not even listed."""
        ddl = f"{self.schema}, `{self.partition}` {self.partition_type}"
        if not folder_exists(self.spark, self.path):
            return self.spark.createDataFrame([], ddl)
        rows = self.spark.read.schema(ddl).parquet(self.path)
        return rows if values is None else rows.where(self.among(values))

    def among(self, values: Sequence) -> Column:
        """Whether a row is of one of the partitions; NULL is a partition as well."""
        column = F.col(self.partition)
        tests = [column.isin([v for v in values if v is not None])]
        if None in values:
            tests.append(column.isNull())
        return reduce(or_, tests)

    def values_of(self, rows: DataFrame) -> list:
        """The partitions that some rows belong to."""
        found = rows.select(self.partition).distinct().collect()
        return sorted((r[0] for r in found), key=lambda v: (v is not None, v))

    def replace(self, rows: DataFrame, values: Sequence) -> int:
        """Make `rows` the whole content of these partitions and leave all others alone.

        New files are written beside the old ones and moved into place when all are there, so
        `rows` may be read from this table. Rows of other partitions are an error. A partition
        for which there are no rows is removed. Run again after a failure, it gives the same.
        """
        alien = F.raise_error(F.lit(f"a row of a partition that is not replaced in {self.path}"))
        checked = rows.where(F.when(self.among(values), True).otherwise(alien.cast("boolean")))
        names = [field.split()[0].strip("`") for field in self.schema.split(", ")]
        observed = Observation()
        # Few files to a partition, several to a large one.
        spread = checked.select(*names, self.partition).hint("rebalance", F.col(self.partition))
        counted = spread.observe(
            observed, F.count(F.lit(1)).alias("rows"), F.collect_set(self.partition).alias("values"),
            F.count_if(F.col(self.partition).isNull()).alias("unknown"),
        )
        target = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        target.partitionBy(self.partition).parquet(self.path)
        found = observed.get
        there = {*found["values"], *([None] if found["unknown"] else [])}
        for value in set(values) - there:
            folder = "__HIVE_DEFAULT_PARTITION__" if value is None else value
            remove_folder(self.spark, f"{self.path}/{self.partition}={folder}")
        return found["rows"]
