"""Validator truth tables, bounds, NaN / NULL, unknown sensors, SQL functions."""

import math

import pytest
from pyspark.sql import functions as F

from vitalis.functions import validation as V
from vitalis.operators import quality as Q
from tests.conftest import readings_df


def _eval(spark, expr, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in df.select(expr).collect()]


@pytest.mark.parametrize(
    "param,value,ok",
    [
        ("pulse", 75.0, True), ("pulse", 25.0, False), ("pulse", 250.0, False),
        ("temperature", 36.8, True), ("temperature", 34.0, False), ("temperature", 43.0, False),
        ("spo2", 98.0, True), ("spo2", 65.0, False),
        ("pulse", 35.0, True),
    ],
)
def test_truth_table(spark, param, value, ok):
    assert _eval(spark, V.in_range(param, "x"), [value]) == [ok]


@pytest.mark.parametrize(
    "sys_,dia,ok",
    [(120.0, 80.0, True), (55.0, 80.0, False), (260.0, 80.0, False), (120.0, 35.0, False), (120.0, 160.0, False)],
)
def test_bp_truth_table(spark, sys_, dia, ok):
    df = spark.createDataFrame([(sys_, dia)], "systolic double, diastolic double")
    assert df.select(V.bp_is_valid()).first()[0] is ok


def test_bounds_inclusive_nan_null(spark):
    got = _eval(spark, V.in_range("pulse", "x"), [30.0, 220.0, 29.999, 220.001, math.nan, None])
    assert got == [True, True, False, False, False, None]


def test_error_codes_and_messages(spark):
    rows = spark.createDataFrame([(75.0,), (250.0,), (None,)], "x double").select(V.validate_pulse("x").alias("c"))
    got = [(r.c.is_valid, r.c.error_code, r.c.error_message) for r in rows.collect()]
    assert got == [(True, 0, None), (False, 1, "Pulse outside valid range"), (None, None, None)]
    codes = {
        p: spark.range(1).select(V.check(p, F.lit(-1.0))["error_code"]).first()[0]
        for p in ["pulse", "systolic", "diastolic", "temperature", "spo2"]
    }
    assert codes == {"pulse": 1, "systolic": 2, "diastolic": 3, "temperature": 4, "spo2": 5}


def test_status(spark):
    got = _eval(spark, V.status("pulse", "x"), [75.0, 35.0, 250.0, None])
    assert got == ["normal", "valid", "invalid", None]


def test_unknown_sensor_is_invalid_code_zero(spark):
    df = readings_df(spark, [(1, "P001", "glucose", 5.0, None, None, 0)])
    r = Q.validation_detail(df).first()
    assert (r.is_valid, r.error_code, r.error_message) == (False, 0, None)


def test_bp_detail_reports_systolic_first(spark):
    df = readings_df(
        spark,
        [
            (1, "P001", "blood_pressure", 0.0, 50.0, 20.0, 0),
            (2, "P001", "blood_pressure", 0.0, 120.0, 20.0, 1),
            (3, "P001", "blood_pressure", 0.0, 120.0, 80.0, 2),
        ],
    )
    got = {r.event_id: (r.is_valid, r.error_code) for r in Q.validation_detail(df).collect()}
    assert got == {1: (False, 2), 2: (False, 3), 3: (True, 0)}


def test_sql_functions(spark):
    V.register_sql_functions(spark)
    r = spark.sql("SELECT validate_pulse(250.0).error_code AS c, status_spo2(96.0) AS s, validate_systolic(120.0).is_valid AS v").first()
    assert (r.c, r.s, r.v) == (1, "normal", True)


def test_validated_projections(spark):
    df = readings_df(
        spark,
        [
            (1, "P001", "pulse", 75.0, None, None, 0.5),
            (2, "P001", "pulse", 250.0, None, None, 1.0),
            (3, "P002", "blood_pressure", 0.0, 120.0, 80.0, 2.0),
            (4, "P002", "blood_pressure", 0.0, 120.0, 35.0, 3.0),
        ],
    )
    v = {(r.value, r.is_valid) for r in Q.validated_readings(df).collect()}
    assert v == {(75.0, True), (250.0, False)}
    bp = sorted((r.diastolic, r.is_valid) for r in Q.validated_bp(df).collect())
    assert bp == [(35.0, False), (80.0, True)]
    wide = Q.validated_union(df)
    assert set(wide.columns) == {"patient_id", "sensor_type", "value", "timestamp", "is_valid", "systolic", "diastolic"}
    assert wide.count() == 4
