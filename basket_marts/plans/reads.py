"""Read-side queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOURS = range(24)


def hourly_pivot(hourly: DataFrame) -> DataFrame:
    """One row per weekday, one column h0..h23 per hour, 0 where there were no orders.

    The hours are listed, so no job has to find them first. Any other hour, or none, is an
    error: it has no column to appear in.
    """
    hour = F.col("order_hour")
    listed = F.when(hour.isin(*HOURS), hour).otherwise(
        F.raise_error(F.concat(F.lit("no hour of the day: "), F.coalesce(hour.cast("string"), F.lit("NULL"))))
    )
    demand = hourly.select("order_dow", listed.alias("order_hour"), "n_orders")
    pivoted = demand.groupBy("order_dow").pivot("order_hour", list(HOURS)).agg(F.sum("n_orders"))
    return pivoted.na.fill(0).select(
        "order_dow", *(F.col(f"`{hour}`").alias(f"h{hour}") for hour in HOURS)
    )


def departments_by_rate(kpis: DataFrame) -> DataFrame:
    return kpis.select("department", "reorder_rate").orderBy(F.desc("reorder_rate"), "department")
