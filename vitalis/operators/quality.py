"""Validated projections, range lookups, quality report and alerts.

P3, P4, V6-V10, J1.  The quality report and the alerts are single-pass
conditional aggregates (``count_if`` per rule) instead of one filter per
rule; a group-by on sensor type pre-aggregates map-side, so a sensor holding
a third of all rows costs nothing extra at the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis.functions.scalar import ts_to_epoch
from vitalis.functions.validation import bp_is_valid, in_range, reading_check, status_by_param
from vitalis.schema import BLOOD_PRESSURE, SCALAR_SENSORS, ranges_df


def validated_readings(readings: DataFrame) -> DataFrame:
    """Scalar readings with epoch-second timestamp and validity flag."""
    scalar = readings.filter(F.col("sensor_type") != BLOOD_PRESSURE)
    s, v = F.col("sensor_type"), F.col("value")
    ok = (
        F.when(s == "pulse", in_range("pulse", v))
        .when(s == "temperature", in_range("temperature", v))
        .when(s == "spo2", in_range("spo2", v))
        .otherwise(F.lit(False))
    )
    return scalar.select(
        "patient_id", "sensor_type", "value", ts_to_epoch("ts").alias("timestamp"), ok.alias("is_valid")
    )


def validated_bp(readings: DataFrame) -> DataFrame:
    """P4 + V6: blood-pressure readings; valid only when both parts are."""
    return readings.filter(F.col("sensor_type") == BLOOD_PRESSURE).select(
        "patient_id",
        "sensor_type",
        "systolic",
        "diastolic",
        ts_to_epoch("ts").alias("timestamp"),
        bp_is_valid().alias("is_valid"),
    )


def validated_union(readings: DataFrame) -> DataFrame:
    """D4 + P9: both record kinds in one wide output."""
    return validated_readings(readings).unionByName(validated_bp(readings), allowMissingColumns=True)


def validation_detail(readings: DataFrame) -> DataFrame:
    """Per reading: validity, error code and message."""
    chk = reading_check()
    return readings.select(
        "event_id",
        "sensor_type",
        chk["is_valid"].alias("is_valid"),
        chk["error_code"].alias("error_code"),
        chk["error_message"].alias("error_message"),
    )


def measures(readings: DataFrame) -> DataFrame:
    """Long form: one row per (reading, parameter).

    Scalar readings give (sensor_type, value); blood pressure gives systolic
    and diastolic rows.  One pass (generator), no self-union re-scan.
    """
    is_bp = F.col("sensor_type") == BLOOD_PRESSURE
    pairs = F.when(
        is_bp,
        F.array(
            F.struct(F.lit("systolic").alias("param"), F.col("systolic").alias("measure")),
            F.struct(F.lit("diastolic").alias("param"), F.col("diastolic").alias("measure")),
        ),
    ).otherwise(F.array(F.struct(F.col("sensor_type").alias("param"), F.col("value").alias("measure"))))
    return readings.select("event_id", "patient_id", "ts", F.inline(pairs))


def range_lookup(readings: DataFrame) -> DataFrame:
    """V7 + J1: bounds of each measure from the (broadcast) range table.

    The range table has five rows and a fixed size, so the broadcast is safe at
    any data size; unknown parameters keep NULL bounds (left join).
    """
    ranges = ranges_df(readings.sparkSession).select("param", "min", "max", "normal_min", "normal_max")
    return measures(readings).join(F.broadcast(ranges), "param", "left").select(
        "event_id", "param", "measure", "min", "max", "normal_min", "normal_max"
    )


def normal_status(readings: DataFrame) -> DataFrame:
    """V8: normal / valid / invalid per measure, plus ``is_normal``."""
    st = status_by_param("param", "measure")
    return measures(readings).select(
        "event_id", "param", "measure", st.alias("status"), F.coalesce(st == "normal", F.lit(False)).alias("is_normal")
    )


# ---------------------------------------------------------------------------
# Alert texts and the order and labels of quality-report issues.
# ---------------------------------------------------------------------------
ALERT_LOW = "Low %s: %d readings below normal"
ALERT_HIGH = "High %s: %d readings above normal"
_ISSUES = [
    ("pulse", "value", "pulse", "Invalid pulse readings: "),
    ("temperature", "value", "temperature", "Invalid temperature readings: "),
    ("spo2", "value", "spo2", "Invalid SpO2 readings: "),
    (None, "systolic", "systolic", "Invalid systolic readings: "),
    (None, "diastolic", "diastolic", "Invalid diastolic readings: "),
]


def quality_counts() -> list[Column]:
    """The report's aggregates: rows, and bad measures of each rule (``n_<param>``)."""
    counts = [F.count(F.lit(1)).alias("total_records")]
    for sensor, column, param, _ in _ISSUES:
        bad = ~in_range(param, column)
        if sensor is not None:
            bad = (F.col("sensor_type") == sensor) & bad
        counts.append(F.count_if(bad).alias(f"n_{param}"))
    return counts


def report_of(counts: DataFrame) -> DataFrame:
    """total_records and the list of non-zero issue strings, from a row of :func:`quality_counts`."""
    issues = F.filter(
        F.array(
            *[
                F.when(F.col(f"n_{param}") > 0, F.concat(F.lit(label), F.col(f"n_{param}").cast("string")))
                for _, _, param, label in _ISSUES
            ]
        ),
        lambda x: x.isNotNull(),
    )
    return counts.select("total_records", issues.alias("issues"))


def quality_report(readings: DataFrame) -> DataFrame:
    """V9: total rows and the list of non-zero issue strings, one scan.

    Scalar rules apply to rows of that sensor; the blood-pressure rules apply
    to every row that has the column filled.  NULL measures are no issue.
    """
    return report_of(readings.agg(*quality_counts()))


def _alerts(long: DataFrame, params: list[str]) -> DataFrame:
    ranges = ranges_df(long.sparkSession).filter(F.col("param").isin(params))
    joined = long.join(F.broadcast(ranges.select("param", "normal_min", "normal_max")), "param")
    counted = joined.groupBy("param").agg(
        F.count_if(F.col("measure") < F.col("normal_min")).alias("low"),
        F.count_if(F.col("measure") > F.col("normal_max")).alias("high"),
    )
    order = {p: i for i, p in enumerate(params)}
    rank = F.create_map(*[x for p, i in order.items() for x in (F.lit(p), F.lit(i))])
    longer = counted.select(
        "param",
        F.inline(
            F.array(
                F.struct(F.lit("low").alias("level"), F.col("low").alias("n")),
                F.struct(F.lit("high").alias("level"), F.col("high").alias("n")),
            )
        ),
    ).filter(F.col("n") > 0)
    text = F.when(
        F.col("level") == "low", F.format_string(ALERT_LOW, F.col("param"), F.col("n"))
    ).otherwise(F.format_string(ALERT_HIGH, F.col("param"), F.col("n")))
    return longer.select(
        F.col("param").alias("sensor_type"), "level", "n", text.alias("alert"), rank[F.col("param")].alias("ord")
    ).orderBy("ord", F.desc("level")).drop("ord")


def alerts(readings: DataFrame) -> DataFrame:
    """low/high counts against the normal band for pulse, temperature, SpO2.

    Blood pressure is skipped, as in the reference (T15); see ``alerts_bp``.
    """
    scalar = readings.filter(F.col("sensor_type").isin(list(SCALAR_SENSORS))).select(
        F.col("sensor_type").alias("param"), F.col("value").alias("measure")
    )
    return _alerts(scalar, list(SCALAR_SENSORS))


def alerts_bp(readings: DataFrame) -> DataFrame:
    """T15 extra: the same alerts for systolic and diastolic pressure."""
    bp = measures(readings.filter(F.col("sensor_type") == BLOOD_PRESSURE)).select("param", "measure")
    return _alerts(bp, ["systolic", "diastolic"])


__all__ = [
    "validated_readings",
    "validated_bp",
    "validated_union",
    "validation_detail",
    "measures",
    "range_lookup",
    "normal_status",
    "quality_report",
    "alerts",
    "alerts_bp",
]
