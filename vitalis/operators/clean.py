"""Null handling and duplicate removal.

NULL checks use ``isNotNull`` conjunctions, never ``na.drop()``, which would
also drop NaN (T5).  Duplicate removal keeps the row that sorts first by all
its columns (T6), as a ``min(struct)`` aggregate with a map-side partial step:
a heavily duplicated key is collapsed before the shuffle, and a retried task
keeps the same row.  ``keep='any'`` is ``dropDuplicates``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.schema import BLOOD_PRESSURE

DEDUP_KEY = ["patient_id", "ts", "sensor_type"]
# Columns of a source record; ids and time texts that only some sources have don't count as missing.
RECORD = ["patient_id", "sensor_type", "value", "systolic", "diastolic", "ts"]


def drop_any_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """F5 (strict): drop a row when any of ``columns`` (default all) is NULL."""
    cols = columns or df.columns
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def drop_missing_required(df: DataFrame) -> DataFrame:
    """F5 (required): drop a row when an identity field or its own measure is NULL.

    Identity: patient_id, sensor_type, ts.  Measure: systolic and diastolic for
    blood pressure, value for every other sensor.
    """
    is_bp = F.col("sensor_type") == BLOOD_PRESSURE
    measure_ok = F.when(is_bp, F.col("systolic").isNotNull() & F.col("diastolic").isNotNull()).otherwise(
        F.col("value").isNotNull()
    )
    return df.filter(
        F.col("patient_id").isNotNull() & F.col("sensor_type").isNotNull() & F.col("ts").isNotNull() & measure_ok
    )


def dedupe(df: DataFrame, key: list[str] | None = None, keep: str = "first", order_by: list[str] | None = None) -> DataFrame:
    """One row per ``key``.

    ``keep='any'`` keeps an unspecified row (as the reference does).
    ``keep='first'`` keeps the first row by ``order_by`` (default: all other
    columns), so the kept row is deterministic.
    """
    key = key or DEDUP_KEY
    if keep == "any":
        return df.dropDuplicates(key)
    # min over a struct (order columns first) is a partial + final aggregate:
    # copies of one key are collapsed map-side, so even a key holding a third
    # of all rows never reaches one reducer whole (a row_number window would
    # sort them all in one task).  Struct order puts NULLs first, so the order
    # columns are keyed by (is NULL, value) to sort NULLs last.
    order = order_by or [c for c in df.columns if c not in key]
    rest = [c for c in df.columns if c not in key and c not in order]
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}")]
    fields += [F.col(c).alias(f"_r_{c}") for c in rest]
    best = df.groupBy(*key).agg(F.min(F.struct(*fields)).alias("_best"))
    cols = {c: F.col(c) for c in key}
    cols.update({c: F.col(f"_best._o{i}") for i, c in enumerate(order)})
    cols.update({c: F.col(f"_best._r_{c}") for c in rest})
    return best.select(*[cols[c].alias(c) for c in df.columns])


def clean(df: DataFrame, mode: str = "required", keep: str = "first") -> DataFrame:
    """D3: null removal, then duplicate removal on (patient_id, ts, sensor_type).

    ``mode='strict'`` is the reference behaviour (any NULL column drops the
    row; in a mixed table only blood-pressure rows survive, T4).
    ``mode='required'`` checks only the fields the reading needs.
    """
    if mode == "strict":
        base = drop_any_null(df, [c for c in df.columns if c in RECORD])
    elif mode == "required":
        base = drop_missing_required(df)
    else:
        raise ValueError(f"unknown clean mode {mode!r}")
    return dedupe(base, keep=keep)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed."""
    return df.distinct()
