"""Group-bys and global aggregates.

Every aggregate here is algebraic (count, sum, min, max, moments) or a
distinct count, so Spark plans a partial aggregate before the shuffle and a
final one after it: a hot sensor or patient is collapsed map-side and never
lands whole on one reducer.  Shares over a total are computed after the
group-by, on the already tiny grouped result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis.functions.scalar import age_seconds, clock_minute, ts_micros, ts_to_epoch
from vitalis.functions.stats import avg_col, fixed_avg_sql


def _r(col: Column, digits: int | None) -> Column:
    return F.round(col, digits) if digits is not None else col


def distinct_with_null(col: str) -> Column:
    """Distinct count that counts NULL as one more value."""
    return F.countDistinct(F.col(col)) + F.max(F.col(col).isNull().cast("int"))


def by_sensor(readings: DataFrame, digits: int | None = None) -> DataFrame:
    """A1: count of all rows, avg, min, max and sample std per sensor."""
    return readings.groupBy("sensor_type").agg(
        F.count(F.lit(1)).alias("count"),
        avg_col("value", digits).alias("avg"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        _r(F.stddev_samp("value"), digits).alias("std"),
    )


def by_patient(readings: DataFrame) -> DataFrame:
    """A2 / A10: rows and distinct sensor types (NULL counted) per patient."""
    return readings.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_readings"),
        distinct_with_null("sensor_type").alias("sensor_types"),
    )


def patient_summary(readings: DataFrame) -> DataFrame:
    """A10: data behind the per-patient bar chart."""
    return readings.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("readings"),
        distinct_with_null("sensor_type").alias("sensors"),
    )


def sensor_stats_sql_text(view: str = "readings", digits: int | None = None) -> str:
    """A3 + O1 as SQL text over a view or a ``parquet.`path` `` relation."""
    avg = fixed_avg_sql("value", digits) if digits is not None else "AVG(value)"
    return f"""
        SELECT sensor_type,
               COUNT(*) AS count,
               {avg} AS avg_value,
               MIN(value) AS min_value,
               MAX(value) AS max_value
        FROM {view}
        WHERE sensor_type IS NOT NULL AND value > 0
        GROUP BY sensor_type
        ORDER BY count DESC, sensor_type
    """


def patient_stats_sql_text(view: str = "readings") -> str:
    """A4 + O2 as SQL text (plain COUNT DISTINCT: NULL ignored)."""
    return f"""
        SELECT patient_id,
               COUNT(*) AS readings,
               COUNT(DISTINCT sensor_type) AS sensors
        FROM {view}
        GROUP BY patient_id
        ORDER BY readings DESC, patient_id
    """


def sensor_stats_df(readings: DataFrame, digits: int | None = None) -> DataFrame:
    """A3 + O1 in the DataFrame API (same plan as the SQL text)."""
    return (
        readings.filter(F.col("sensor_type").isNotNull() & (F.col("value") > 0))
        .groupBy("sensor_type")
        .agg(
            F.count(F.lit(1)).alias("count"),
            avg_col("value", digits).alias("avg_value"),
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
        )
        .orderBy(F.desc("count"), "sensor_type")
    )


def value_stats(readings: DataFrame, digits: int | None = None) -> DataFrame:
    """A5: avg / min / max of a value list; an empty input gives zeros."""
    return readings.agg(
        F.count(F.lit(1)).alias("count"),
        F.coalesce(avg_col("value", digits), F.lit(0.0)).alias("avg"),
        F.coalesce(F.min("value"), F.lit(0.0)).alias("min"),
        F.coalesce(F.max("value"), F.lit(0.0)).alias("max"),
    )


def filtered_stats(readings: DataFrame, sensor: str, digits: int | None = None) -> DataFrame:
    """Global stats of one sensor."""
    return readings.filter(F.col("sensor_type") == sensor).agg(
        avg_col("value", digits).alias("avg"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count(F.lit(1)).alias("count"),
    )


def count_per_patient(readings: DataFrame) -> DataFrame:
    """Rows per patient."""
    return readings.groupBy("patient_id").agg(F.count(F.lit(1)).alias("count"))


def count_avg_per_sensor(readings: DataFrame, digits: int | None = None) -> DataFrame:
    """Rows and average value per sensor."""
    return readings.groupBy("sensor_type").agg(
        F.count(F.lit(1)).alias("count"), avg_col("value", digits).alias("avg_value")
    )


def sensor_distribution(readings: DataFrame, digits: int | None = None) -> DataFrame:
    """Count and share (%) per sensor; a missing sensor counts as 'unknown'.

    The total is a window over the grouped result, which has one row per
    sensor type, so the single-partition step only sees a handful of rows.
    """
    grouped = readings.groupBy(F.coalesce(F.col("sensor_type"), F.lit("unknown")).alias("sensor_type")).agg(
        F.count(F.lit(1)).alias("count")
    )
    total = F.sum("count").over(Window.partitionBy())
    return grouped.select(
        "sensor_type", "count", _r(F.col("count") * F.lit(100.0) / total, digits).alias("share_pct")
    ).orderBy(F.desc("count"), "sensor_type")


def per_clock_minute(readings: DataFrame, ts: str = "ts") -> DataFrame:
    """A7 (faithful): rows per 'HH:mm' clock minute, days merged, sorted."""
    return (
        readings.groupBy(clock_minute(ts).alias("minute"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("minute")
    )


def per_minute(readings: DataFrame, ts: str = "ts") -> DataFrame:
    """A7 (true minute): rows per calendar minute (UTC), sorted."""
    return (
        readings.groupBy(F.date_trunc("minute", F.col(ts)).alias("minute"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("minute")
    )


def histogram(
    readings: DataFrame,
    sensors: tuple[str, ...] = ("pulse", "temperature", "spo2"),
    bins: int = 30,
    digits: int | None = None,
) -> DataFrame:
    """Equal-width histogram of values per sensor, ``bins`` bins.

    Per-sensor min/max is a group-by with at most ``len(sensors)`` rows, so it
    is broadcast with a proven bound; the rows are then binned in one pass and
    counted with a partial + final aggregate.  The maximum falls into the last
    bin; a constant series (width 0) goes to bin 0.  NULL, NaN and infinite
    values are in no bin.
    """
    data = readings.filter(F.col("sensor_type").isin(list(sensors)) & (F.abs("value") < float("inf")))
    bounds = data.groupBy("sensor_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    bin_idx = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(
        F.lit(0)
    )
    binned = data.join(F.broadcast(bounds), "sensor_type").select(
        "sensor_type", bin_idx.cast("int").alias("bin"), "lo", "hi"
    )
    out = binned.groupBy("sensor_type", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return out.select(
        "sensor_type",
        "bin",
        _r(F.col("lo") + F.col("bin") * w, digits).alias("bin_start"),
        _r(F.col("lo") + (F.col("bin") + 1) * w, digits).alias("bin_end"),
        "count",
    ).orderBy("sensor_type", "bin")


def kpis(readings: DataFrame, as_of: str, ts: str = "ts") -> DataFrame:
    """A9 + P16: one row of dashboard tiles in a single aggregate pass."""
    as_of_col = F.lit(as_of).cast("timestamp")
    return readings.agg(
        F.count(F.lit(1)).alias("total_readings"),
        distinct_with_null("patient_id").alias("patients"),
        distinct_with_null("sensor_type").alias("sensor_types"),
        F.max(ts).alias("latest"),
    ).select(
        "total_readings",
        "patients",
        "sensor_types",
        "latest",
        age_seconds(as_of_col, "latest").alias("age_seconds"),
    )


def distinct_values(readings: DataFrame) -> DataFrame:
    """A16 over a whole table: the distinct patients and sensors ('unknown' for
    missing) as rows ``(kind, value)``.  Distributed: a table-wide list of all
    patients would put an unbounded group into one task and one row."""
    def one(col: str, kind: str) -> DataFrame:
        return readings.select(
            F.lit(kind).alias("kind"), F.coalesce(F.col(col), F.lit("unknown")).alias("value")
        ).distinct()

    return one("patient_id", "patient").unionByName(one("sensor_type", "sensor"))


def distinct_lists(readings: DataFrame) -> DataFrame:
    """Sorted lists of distinct patients and sensors ('unknown' for missing).

    For bounded inputs (one window's rows), as in the window snapshot; use
    ``distinct_values`` for a whole table."""
    return readings.agg(
        F.array_sort(F.collect_set(F.coalesce(F.col("patient_id"), F.lit("unknown")))).alias("patient_ids"),
        F.array_sort(F.collect_set(F.coalesce(F.col("sensor_type"), F.lit("unknown")))).alias("sensor_types"),
    )


def ingest_stats(readings: DataFrame, ts: str = "ts", by: str | None = "sensor_type") -> DataFrame:
    """Rows, time span (s) and rows per second, per sensor or overall."""
    span = (F.max(ts_micros(ts)) - F.min(ts_micros(ts))) / F.lit(1e6)
    grouped = readings.groupBy(by) if by else readings
    out = grouped.agg(F.count(F.lit(1)).alias("num_readings"), span.alias("duration_seconds"))
    rate = F.when(
        F.col("duration_seconds") > 0, F.round(F.col("num_readings") / F.col("duration_seconds"), 2)
    ).otherwise(F.lit(0.0))
    cols = ([by] if by else []) + [
        "num_readings",
        F.round("duration_seconds", 3).alias("duration_seconds"),
        rate.alias("readings_per_second"),
    ]
    return out.select(*cols)


def output_counts(raw: DataFrame, aggregates: DataFrame, size: str, ts: str = "ts") -> DataFrame:
    """Raw and aggregate rows emitted per ``size`` interval, by kind.

    Aggregates are stamped with their own emission time (``timestamp``).
    """
    tagged = raw.select(F.col(ts).alias("at"), F.lit("raw").alias("kind")).unionByName(
        aggregates.select(F.col("timestamp").alias("at"), F.lit("agg").alias("kind"))
    )
    return tagged.groupBy(F.window("at", size).alias("w"), "kind").agg(F.count(F.lit(1)).alias("count")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "kind", "count"
    )


def payload_size(readings: DataFrame, digits: int | None = None) -> DataFrame:
    """Bytes per sensor as JSON lines vs the fixed binary record layout.

    JSON: text of the four transport fields plus a newline.  Binary: each
    string is an 8-byte length plus its bytes, the value and the timestamp are
    8 bytes each.
    """
    transport = readings.select(
        "patient_id", "sensor_type", "value", ts_to_epoch("ts").alias("timestamp")
    )
    json_len = F.octet_length(F.to_json(F.struct("patient_id", "sensor_type", "value", "timestamp"))) + 1
    bin_len = (
        F.lit(8) + F.coalesce(F.octet_length("patient_id"), F.lit(0))
        + F.lit(8) + F.coalesce(F.octet_length("sensor_type"), F.lit(0))
        + F.lit(16)
    )
    out = transport.groupBy("sensor_type").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(json_len).alias("json_bytes"),
        F.sum(bin_len).alias("binary_bytes"),
    )
    return out.withColumn("ratio", _r(F.col("json_bytes") / F.col("binary_bytes"), digits))
