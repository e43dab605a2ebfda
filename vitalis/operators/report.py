"""Dashboard data: ordered and limited views (O3-O6) and the series with its band.

Top-k here is ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject: each task keeps its own k best rows and only k rows
per task reach the final merge, so no global sort of the table happens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.schema import ranges_df


def recent(readings: DataFrame, n: int = 20, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """O3: the ``n`` most recent rows (ties broken by id, newest first)."""
    return readings.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(n)


def last_rows(readings: DataFrame, n: int = 20, order: str = "event_id") -> DataFrame:
    """The last ``n`` rows when there is no time column.

    Row position is not defined in a distributed table, so 'last' means the
    highest values of an explicit ordering column.
    """
    return readings.orderBy(F.col(order).desc()).limit(n)


def sensor_series(readings: DataFrame, sensor: str = "pulse", ts: str = "ts") -> DataFrame:
    """O6 + J1: one sensor's series with its normal band, ordered by time."""
    band = ranges_df(readings.sparkSession).select(
        F.col("param").alias("sensor_type"), "normal_min", "normal_max"
    )
    return (
        readings.filter(F.col("sensor_type") == sensor)
        .join(F.broadcast(band), "sensor_type", "left")
        .select("event_id", ts, "patient_id", "value", "normal_min", "normal_max")
        .orderBy(ts, "event_id")
    )
