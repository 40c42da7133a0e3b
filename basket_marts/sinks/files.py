from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _write_parquet(rows: DataFrame, path: str) -> int:
    """Overwrite `path`; the row count is observed while writing, not by a second run."""
    observed = Observation()
    counted = rows.observe(observed, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").parquet(path)
    return observed.get["rows"]


def write_natural(rows: DataFrame, path: str) -> int:
    """Files as the last stage left them. AQE has already merged small partitions."""
    return _write_parquet(rows, path)


def write_compact(rows: DataFrame, path: str) -> int:
    """As few files as the volume allows: one for a small result, several for a large
    one. The exchange comes after the work, so only result rows move.
    """
    return _write_parquet(rows.hint("rebalance"), path)


def write_even(rows: DataFrame, path: str, files: int) -> int:
    """Exactly `files` files of about equal size, at the price of one more shuffle."""
    return _write_parquet(rows.repartition(files), path)


def run_to_nowhere(rows: DataFrame) -> None:
    """Execute the whole plan and discard the rows."""
    rows.write.format("noop").mode("overwrite").save()


def write_json(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("overwrite").json(path)
