"""Scalar projections (P1, P2, P6, P7, P11-P15) as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalis.schema import SHARD_SENSOR_ORDER


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_to_ts(seconds) -> Column:
    """Epoch seconds (float or int) to TIMESTAMP, keeping the fraction."""
    return F.timestamp_seconds(_c(seconds))


def as_instant(ts) -> Column:
    """A TIMESTAMP (instant) view of a time column.

    Readings keep the source type of their time column, so predicates on it
    reach the Parquet scan; the driver tables store TIMESTAMP_NTZ wall-clock
    time in UTC, which the UTC session reads as the same instant.
    """
    return _c(ts).cast("timestamp")


def ts_to_epoch(ts) -> Column:
    """Time to whole epoch seconds (BIGINT)."""
    return F.unix_seconds(as_instant(ts))


def ts_to_epoch_float(ts) -> Column:
    """Time to fractional epoch seconds (DOUBLE)."""
    return F.unix_micros(as_instant(ts)) / F.lit(1_000_000.0)


def ts_micros(ts) -> Column:
    """Time to integer epoch microseconds, the unit of all window frames."""
    return F.unix_micros(as_instant(ts))


def with_default(col, default) -> Column:
    """Value of a possibly missing field, with a default."""
    return F.coalesce(_c(col), F.lit(default))


def composite_key(patient="patient_id", sensor="sensor_type") -> Column:
    """``patient + '_' + sensor``."""
    return F.concat_ws("_", _c(patient), _c(sensor))


def split_key(key) -> tuple[Column, Column]:
    """P7 inverse that knows the sensor names, so ``P001_blood_pressure``
    splits into ``P001`` and ``blood_pressure`` (not at the last ``_``)."""
    alternatives = "|".join(sorted(SHARD_SENSOR_ORDER, key=len, reverse=True))
    pattern = rf"^(.*)_({alternatives})$"
    k = _c(key)
    return F.regexp_extract(k, pattern, 1), F.regexp_extract(k, pattern, 2)


def round_to(col, digits: int = 1) -> Column:
    """Rounding to n decimals (half up)."""
    return F.round(_c(col), digits)


def clock_minute(ts) -> Column:
    """Clock minute 'HH:mm' (merges days, as the reference does)."""
    return F.date_format(_c(ts), "HH:mm")


def iso_text(ts) -> Column:
    """ISO-8601 text of a timestamp."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def patient_code(n) -> Column:
    """Zero-padded patient id ``P%03d``."""
    return F.format_string("P%03d", _c(n))


def age_seconds(as_of, newest) -> Column:
    """Whole seconds from the newest row to ``as_of`` (all days counted)."""
    return F.unix_seconds(as_instant(as_of)) - F.unix_seconds(as_instant(newest))
