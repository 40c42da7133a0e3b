from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basket_marts import schemas

# What `read_csv_audited` adds to a row.
RECORD, FILE = "_record", "_file"


def read_csv(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Headered CSV, one file or several read as one table, under a given schema.

    Columns go by position; a cell that does not parse is NULL, a short row is padded
    with NULL, extra cells are dropped.
    """
    return spark.read.schema(schema).csv(paths, header=True)


def read_csv_audited(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """The rows of `read_csv` with two more columns: `_record`, the line as it stands in the
    file where a cell does not parse or cells are missing or left over, else NULL; and
    `_file`, the path it was read from.

    The number of cells is judged whatever columns are used. A cell is only parsed where its
    column is used, so keep all columns as long as `_record` matters.
    """
    reader = spark.read.schema(f"{schema}, `{RECORD}` STRING").option("columnPruning", "false")
    rows = reader.csv(paths, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
    return rows.select("*", F.col("_metadata.file_path").alias(FILE))


def split_of_file(file: Column) -> Column:
    """The split that an item file's name tells; any other file is an error."""
    unknown = F.raise_error(F.concat(F.lit("a file of neither split: "), file))
    split = F.when(file.contains(f"/{schemas.PRIOR_ITEMS_FILE}"), schemas.PRIOR)
    return split.when(file.contains(f"/{schemas.TRAIN_ITEMS_FILE}"), schemas.TRAIN).otherwise(unknown)


@dataclass(frozen=True)
class RawFiles:
    """The raw drop: one folder of CSV files. `audited` adds the columns of
    `read_csv_audited` to every table."""

    spark: SparkSession
    root: str
    audited: bool = False

    def _read(self, files: str | list[str], schema: str) -> DataFrame:
        read = read_csv_audited if self.audited else read_csv
        files = [files] if isinstance(files, str) else files
        return read(self.spark, [f"{self.root}/{file}" for file in files], schema)

    def dimension(self, dimension: schemas.Dimension) -> DataFrame:
        return self._read(dimension.file, dimension.schema)

    def orders(self) -> DataFrame:
        return self._read(schemas.ORDERS_FILE, schemas.ORDERS_SCHEMA)

    def prior_items(self) -> DataFrame:
        return self._read(schemas.PRIOR_ITEMS_FILE, schemas.ITEMS_SCHEMA)

    def train_items(self) -> DataFrame:
        return self._read(schemas.TRAIN_ITEMS_FILE, schemas.ITEMS_SCHEMA)

    def all_items(self) -> DataFrame:
        """Both item files scanned as one table, uncleaned."""
        return self._read([schemas.PRIOR_ITEMS_FILE, schemas.TRAIN_ITEMS_FILE], schemas.ITEMS_SCHEMA)

    def tagged_items(self) -> DataFrame:
        """Both item files in one scan, each row tagged with the split that its file names."""
        items = self.all_items()
        file = F.col(FILE) if self.audited else F.col("_metadata.file_path")
        return items.withColumn("eval_set", split_of_file(file))
