"""Validation rules as Spark column expressions (V1-V8).

Every rule is a plain Catalyst expression, so it is constant-folded and runs
inside whole-stage codegen; no Python runs per row.  Bounds are inclusive at
both ends.  NaN fails the upper-bound test (Spark orders NaN above every
number), so it is invalid, as in the reference.  A NULL measure gives a NULL
verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from vitalis.schema import BLOOD_PRESSURE, RANGE_BY_PARAM, RANGES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def in_range(param: str, measure) -> Column:
    """Hard-range check of one parameter, inclusive at both ends."""
    _, lo, hi, *_ = RANGE_BY_PARAM[param]
    m = _c(measure)
    return (m >= F.lit(lo)) & (m <= F.lit(hi))


def in_normal(param: str, measure) -> Column:
    """Normal-band check of one parameter, inclusive at both ends."""
    _, _, _, nlo, nhi, *_ = RANGE_BY_PARAM[param]
    m = _c(measure)
    return (m >= F.lit(nlo)) & (m <= F.lit(nhi))


def check(param: str, measure) -> Column:
    """STRUCT<is_valid, error_code, error_message> for one parameter (V1-V5)."""
    _, _, _, _, _, code, message = RANGE_BY_PARAM[param]
    ok = in_range(param, measure)
    return F.struct(
        ok.alias("is_valid"),
        F.when(ok, F.lit(0)).when(~ok, F.lit(code)).alias("error_code"),
        F.when(~ok, F.lit(message)).cast("string").alias("error_message"),
    )


def validate_pulse(measure) -> Column:
    return check("pulse", measure)


def validate_systolic(measure) -> Column:
    return check("systolic", measure)


def validate_diastolic(measure) -> Column:
    return check("diastolic", measure)


def validate_temperature(measure) -> Column:
    return check("temperature", measure)


def validate_spo2(measure) -> Column:
    return check("spo2", measure)


def bp_is_valid(systolic="systolic", diastolic="diastolic") -> Column:
    """V6: a blood-pressure reading is valid when both parts are valid."""
    return in_range("systolic", systolic) & in_range("diastolic", diastolic)


def reading_is_valid(sensor="sensor_type", value="value", systolic="systolic", diastolic="diastolic") -> Column:
    """Validity flag of a wide reading; an unknown sensor is invalid."""
    s = _c(sensor)
    return (
        F.when(s == "pulse", in_range("pulse", value))
        .when(s == "temperature", in_range("temperature", value))
        .when(s == "spo2", in_range("spo2", value))
        .when(s == BLOOD_PRESSURE, bp_is_valid(systolic, diastolic))
        .otherwise(F.lit(False))
    )


def reading_check(sensor="sensor_type", value="value", systolic="systolic", diastolic="diastolic") -> Column:
    """STRUCT<is_valid, error_code, error_message> of a wide reading.

    Scalar sensors use their own rule.  Blood pressure reports the systolic
    failure first, then the diastolic one.  An unknown sensor gives an
    invalid result with code 0 and no message (T3).
    """
    s = _c(sensor)
    sys_chk = check("systolic", systolic)
    dia_chk = check("diastolic", diastolic)
    bp = F.when(~sys_chk["is_valid"], sys_chk).when(~dia_chk["is_valid"], dia_chk).when(
        sys_chk["is_valid"] & dia_chk["is_valid"], sys_chk
    )
    unknown = F.struct(
        F.lit(False).alias("is_valid"),
        F.lit(0).alias("error_code"),
        F.lit(None).cast("string").alias("error_message"),
    )
    return (
        F.when(s == "pulse", check("pulse", value))
        .when(s == "temperature", check("temperature", value))
        .when(s == "spo2", check("spo2", value))
        .when(s == BLOOD_PRESSURE, bp)
        .otherwise(unknown)
    )


def status(param: str, measure) -> Column:
    """V8: 'normal' inside the normal band, 'valid' inside the hard range, else 'invalid'."""
    m = _c(measure)
    return (
        F.when(in_normal(param, m), "normal")
        .when(in_range(param, m), "valid")
        .when(m.isNotNull(), "invalid")
    )


def status_by_param(param_col="param", measure="measure") -> Column:
    """V8 for a long (param, measure) table; unknown parameter gives NULL."""
    p = _c(param_col)
    out = None
    for name, *_ in RANGES:
        out = (F.when if out is None else out.when)(p == name, status(name, measure))
    return out


def register_sql_functions(spark: SparkSession) -> None:
    """Expose the rules to SQL users as SQL temporary functions.

    These are SQL-bodied functions, inlined by the analyzer, so a query that
    calls them keeps whole-stage codegen (no Python worker involved).
    """
    for name, lo, hi, nlo, nhi, code, message in RANGES:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION validate_{name}(v DOUBLE) "
            f"RETURNS STRUCT<is_valid: BOOLEAN, error_code: INT, error_message: STRING> "
            f"RETURN named_struct('is_valid', v >= {lo} AND v <= {hi}, "
            f"'error_code', CASE WHEN v >= {lo} AND v <= {hi} THEN 0 "
            f"WHEN NOT (v >= {lo} AND v <= {hi}) THEN {code} END, "
            f"'error_message', CASE WHEN NOT (v >= {lo} AND v <= {hi}) THEN '{message}' END)"
        )
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION status_{name}(v DOUBLE) RETURNS STRING "
            f"RETURN CASE WHEN v >= {nlo} AND v <= {nhi} THEN 'normal' "
            f"WHEN v >= {lo} AND v <= {hi} THEN 'valid' "
            f"WHEN v IS NOT NULL THEN 'invalid' END"
        )
