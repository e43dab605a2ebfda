"""Schemas and the fixed medical constants.

The range table is the only reference data: five parameters with hard and
normal bounds and an error code.  It is tiny and fixed, so it is built as a
literal DataFrame and always broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference (ranges, codes, messages).
# param, hard min, hard max, normal min, normal max, error code, message
# ---------------------------------------------------------------------------
RANGES = [
    ("pulse", 30.0, 220.0, 60.0, 100.0, 1, "Pulse outside valid range"),
    ("systolic", 60.0, 250.0, 90.0, 140.0, 2, "Systolic pressure outside valid range"),
    ("diastolic", 40.0, 150.0, 60.0, 90.0, 3, "Diastolic pressure outside valid range"),
    ("temperature", 35.0, 42.0, 36.1, 37.2, 4, "Temperature outside valid range"),
    ("spo2", 70.0, 100.0, 95.0, 100.0, 5, "SpO2 outside valid range"),
]

# Sensor names (fixed values).
PULSE = "pulse"
TEMPERATURE = "temperature"
SPO2 = "spo2"
BLOOD_PRESSURE = "blood_pressure"
SCALAR_SENSORS = (PULSE, TEMPERATURE, SPO2)
# Order used by shard assignment (fixed value).
SHARD_SENSOR_ORDER = (PULSE, TEMPERATURE, SPO2, BLOOD_PRESSURE)

RANGE_BY_PARAM = {r[0]: r for r in RANGES}

# Timestamp text in JSON lines: ISO-8601 with microseconds and offset, so a
# write/read round trip is exact.
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

RANGES_SCHEMA = T.StructType(
    [
        T.StructField("param", T.StringType(), False),
        T.StructField("min", T.DoubleType(), False),
        T.StructField("max", T.DoubleType(), False),
        T.StructField("normal_min", T.DoubleType(), False),
        T.StructField("normal_max", T.DoubleType(), False),
        T.StructField("error_code", T.IntegerType(), False),
        T.StructField("error_message", T.StringType(), False),
    ]
)

# Wide reading as it arrives in JSON lines: epoch seconds in ``timestamp``,
# optional ISO ``datetime`` / ``ts`` and optional blood-pressure parts.
READING_JSON_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("patient_id", T.StringType(), True),
        T.StructField("sensor_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("systolic", T.DoubleType(), True),
        T.StructField("diastolic", T.DoubleType(), True),
        T.StructField("timestamp", T.DoubleType(), True),
        T.StructField("ts", T.TimestampType(), True),
    ]
)

# Canonical readings table used by every operator.
READINGS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("patient_id", T.StringType(), True),
        T.StructField("sensor_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("systolic", T.DoubleType(), True),
        T.StructField("diastolic", T.DoubleType(), True),
        T.StructField("ts", T.TimestampType(), True),
    ]
)

# Transport record: four columns, patient id nullable, the rest required.
TRANSPORT_SCHEMA = T.StructType(
    [
        T.StructField("patient_id", T.StringType(), True),
        T.StructField("sensor_type", T.StringType(), False),
        T.StructField("value", T.DoubleType(), False),
        T.StructField("timestamp", T.LongType(), False),
    ]
)

# Driver ``events`` table.
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)


def ranges_df(spark: SparkSession) -> DataFrame:
    """The five-row range table (safe to broadcast: fixed size)."""
    rows = ", ".join(f"('{p}', {lo}D, {hi}D, {nlo}D, {nhi}D, {code}, '{text}')" for p, lo, hi, nlo, nhi, code, text in RANGES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(RANGES_SCHEMA.names)})")
