from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basket_marts.functions import flag, ratio


def spread_stats(rows: DataFrame, measure: str) -> DataFrame:
    """One row: mean and sample standard deviation of `measure`."""
    return rows.agg(
        F.avg(measure).alias("mean_rate"),
        F.stddev_samp(measure).alias("stddev_rate"),
    )


def standardise(rows: DataFrame, measure: str, scale: int, threshold: float) -> DataFrame:
    """Add `zscore` (rounded to `scale`) and `is_anomaly` (|rounded zscore| > threshold).

    Mean and deviation come from an uncorrelated scalar subquery: Spark evaluates it
    once and hands the row to every task. Both columns are NULL without a deviation.
    """
    # Counting every column keeps the subquery reading the same columns as `rows`, so
    # that Spark reuses the shuffle that made `rows` instead of running it again.
    present = F.struct(*(F.count(c) for c in rows.columns)).alias("present")
    stats = rows.agg(
        F.struct(
            F.avg(measure).alias("mean"), F.stddev_samp(measure).alias("stddev"), present
        )
    ).scalar()
    centred = F.col(measure) - stats.getField("mean")
    return rows.withColumn(
        "zscore", F.round(ratio(centred, stats.getField("stddev")), scale)
    ).withColumn("is_anomaly", flag(F.abs("zscore") > threshold))
