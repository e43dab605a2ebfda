"""The canonical ``readings`` table and its derivation from the driver data.

``events`` (event_id, ts, user_id, event_type, value, props) is mapped to
wide readings by one projection, so every query reads the driver table and
its work grows with it.  Catalyst prunes the unused ``props`` column and
pushes filters on derived columns down through the projection where it can.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.functions.scalar import patient_code
from vitalis.schema import EVENTS_SCHEMA
from vitalis.session import prepare

# Fixed mapping from event type to sensor (fixed values).
EVENT_TO_SENSOR = [
    ("click", "pulse"),
    ("view", "temperature"),
    ("signup", "spo2"),
    ("purchase", "blood_pressure"),
]
OTHER_SENSOR = "other"

READING_COLUMNS = ["event_id", "patient_id", "sensor_type", "value", "systolic", "diastolic", "ts"]


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver ``events`` table, read with its explicit schema (no schema
    discovery from file footers at planning time)."""
    prepare(spark)
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def event_types_for(sensors: list[str] | tuple[str, ...] | None = None, exclude=None) -> list[str] | None:
    """Raw event types that map to the wanted sensors (None: no restriction)."""
    if sensors is None and exclude is None:
        return None
    mapping = EVENT_TO_SENSOR + [(None, OTHER_SENSOR)]
    keep = [e for e, s in mapping if (sensors is None or s in sensors) and (exclude is None or s not in exclude)]
    return keep


def readings_from_events(events: DataFrame, instant: bool = False, sensors=None, exclude=None) -> DataFrame:
    """Project driver events to wide readings (one row per event).

    ``ts`` keeps the source type (TIMESTAMP_NTZ in the driver data) so time
    predicates reach the Parquet scan; ``instant=True`` casts it to TIMESTAMP
    (needed by watermarks in streams).  ``sensors`` / ``exclude`` restrict the
    sensor types, expressed as a filter on the raw ``event_type`` column,
    which Catalyst pushes into the scan (a filter on the derived
    ``sensor_type`` cannot be pushed).
    """
    raw = event_types_for(sensors, exclude)
    if raw is not None:
        et = F.col("event_type")
        known = [e for e, _ in EVENT_TO_SENSOR]
        if None in raw:  # 'other' (any unmapped type) is wanted: drop the unwanted mapped types
            unwanted = [e for e in known if e not in raw]
            cond = (~et.isin(unwanted) | et.isNull()) if unwanted else None
        else:
            cond = et.isin(raw)
        if cond is not None:
            events = events.filter(cond)
    et = F.col("event_type")
    v = F.col("value").cast("double")
    sensor = None
    for event_type, name in EVENT_TO_SENSOR:
        sensor = (F.when if sensor is None else sensor.when)(et == event_type, F.lit(name))
    sensor = sensor.otherwise(F.lit(OTHER_SENSOR))
    value = (
        F.when(et == "click", v + F.lit(25.0))
        .when(et == "view", F.lit(34.8) + v / F.lit(40.0))
        .when(et == "signup", F.lit(101.0) - v / F.lit(8.0))
        .when(et == "purchase", F.lit(0.0))
        .otherwise(v)
    )
    is_bp = et == "purchase"
    return events.select(
        F.col("event_id"),
        patient_code(F.col("user_id")).alias("patient_id"),
        sensor.alias("sensor_type"),
        value.alias("value"),
        F.when(is_bp, F.lit(55.0) + v).alias("systolic"),
        F.when(is_bp, F.lit(38.0) + v * F.lit(0.6)).alias("diastolic"),
        (F.col("ts").cast("timestamp") if instant else F.col("ts")).alias("ts"),
    )


def readings(spark: SparkSession, sf_dir: str, sensors=None, exclude=None) -> DataFrame:
    """Wide readings over ``{sf_dir}/events.parquet`` (optionally a sensor subset)."""
    return readings_from_events(load_events(spark, sf_dir), sensors=sensors, exclude=exclude)


def dirty_readings_from(clean: DataFrame) -> DataFrame:
    """Deterministic dirt on top of the full readings table.

    The driver data has no duplicates and no NULLs, so clean-up operators
    need injected dirt: every tenth event appears twice, patient_id is NULL
    on every 17th event and value NULL on every 19th.  All rows of the full
    table stay in; the modulo rules only choose where dirt goes.
    """
    eid = F.col("event_id")
    twice = F.when(eid % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    doubled = clean.withColumn("_copy", F.explode(twice))  # one scan
    return doubled.select(
        "event_id",
        F.when(eid % 17 != 0, F.col("patient_id")).alias("patient_id"),
        "sensor_type",
        F.when(eid % 19 != 0, F.col("value")).alias("value"),
        "systolic",
        "diastolic",
        "ts",
    )


def dirty_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_readings_from(readings(spark, sf_dir))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views ``readings`` and ``dirty_readings`` for SQL users."""
    r = readings(spark, sf_dir)
    r.createOrReplaceTempView("readings")
    dirty_readings_from(r).createOrReplaceTempView("dirty_readings")
