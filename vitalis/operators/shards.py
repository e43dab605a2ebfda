"""Shard assignment of sensor types (X1, F7) and per-shard throughput.

Shard k of T owns the sensors at positions ``floor(k*n/T) <= i <
floor((k+1)*n/T)`` of the fixed sensor order.  The mapping has at most n
entries, so it is a literal map expression evaluated inside codegen; no join.
Physically, a shard is a partition of ``repartition(shard)`` or a
``partitionBy('shard_id')`` directory on write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.schema import SHARD_SENSOR_ORDER


def assignment(total_shards: int, sensors: tuple[str, ...] = SHARD_SENSOR_ORDER) -> dict[str, int]:
    """Sensor -> shard id for ``total_shards`` shards."""
    n = len(sensors)
    out = {}
    for k in range(total_shards):
        for i in range(k * n // total_shards, (k + 1) * n // total_shards):
            out[sensors[i]] = k
    return out


def sensors_of_shard(shard_id: int, total_shards: int, sensors: tuple[str, ...] = SHARD_SENSOR_ORDER) -> list[str]:
    n = len(sensors)
    return list(sensors[shard_id * n // total_shards : (shard_id + 1) * n // total_shards])


def shard_of(sensor_col, total_shards: int) -> Column:
    """Shard id of a sensor column; NULL for a sensor outside the order."""
    mapping = assignment(total_shards)
    m = F.create_map(*[x for s, k in mapping.items() for x in (F.lit(s), F.lit(k))])
    col = F.col(sensor_col) if isinstance(sensor_col, str) else sensor_col
    return m[col]


def restrict_to_shard(readings: DataFrame, shard_id: int, total_shards: int) -> DataFrame:
    """rows whose sensor belongs to the shard (pushed down as an IN filter)."""
    return readings.filter(F.col("sensor_type").isin(sensors_of_shard(shard_id, total_shards)))


def with_shard(readings: DataFrame, total_shards: int) -> DataFrame:
    return readings.withColumn("shard_id", shard_of("sensor_type", total_shards))


def shard_counts(readings: DataFrame, total_shards: int) -> DataFrame:
    """Rows per (shard, sensor) for a given shard count; sensors outside
    the shard order belong to no shard and are left out (F7)."""
    return (
        with_shard(readings, total_shards)
        .filter(F.col("shard_id").isNotNull())
        .groupBy("shard_id", "sensor_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("shard_id", "sensor_type")
    )


def shard_throughput(readings: DataFrame, total_shards: int, size: str = "5 seconds", ts: str = "ts") -> DataFrame:
    """Rows processed per shard per interval (rows outside every shard dropped)."""
    g = (
        with_shard(readings, total_shards)
        .filter(F.col("shard_id").isNotNull())
        .groupBy("shard_id", F.window(ts, size).alias("w"))
        .agg(F.count(F.lit(1)).alias("processed"))
    )
    return g.select("shard_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "processed")

