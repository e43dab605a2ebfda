"""Analyzer semantics: filters, group-bys, statistics, cleaning, quality report, alerts."""

import math

from pyspark.sql import functions as F

from vitalis.operators import aggregate as A
from vitalis.operators import clean as C
from vitalis.operators import quality as Q
from tests.conftest import readings_df


def test_filter_by_sensor(sample_readings):
    pulse = sample_readings.filter(F.col("sensor_type") == "pulse")
    assert pulse.count() == 40
    assert {r.sensor_type for r in pulse.collect()} == {"pulse"}


def test_by_sensor_and_patient(sample_readings):
    s = {r.sensor_type: r for r in A.by_sensor(sample_readings).collect()}
    assert set(s) == {"pulse", "temperature", "spo2"}
    assert s["pulse"]["count"] == 40 and s["temperature"]["count"] == 30
    assert (s["spo2"]["min"], s["spo2"]["max"]) == (92.0, 99.25)
    p = {r.patient_id: (r.total_readings, r.sensor_types) for r in A.by_patient(sample_readings).collect()}
    assert p == {w + "-17": (25, 3) for w in "ABCD"}


def test_stats_bounds(sample_readings):
    r = A.filtered_stats(sample_readings, "pulse").first()
    assert (r["min"], r["avg"], r["max"], r["count"]) == (61.0, 70.75, 80.5, 40)


def test_one_row_group_std_is_null(spark):
    df = readings_df(spark, [(1, "P001", "pulse", 70.0, None, None, 0)])
    assert A.by_sensor(df).first()["std"] is None


def test_distinct_counts_null_as_value(spark):
    df = readings_df(
        spark,
        [(1, "P001", "pulse", 70.0, None, None, 0), (2, "P001", None, 70.0, None, None, 1), (3, "P001", "spo2", 97.0, None, None, 2)],
    )
    assert A.by_patient(df).first()["sensor_types"] == 3
    sql = df.sparkSession.sql(A.patient_stats_sql_text("{t}"), t=df).first()
    assert sql["sensors"] == 2


def test_sql_sensor_stats_filter_and_order(spark, sample_readings):
    df = sample_readings.unionByName(readings_df(spark, [(999, "P009", "blood_pressure", 0.0, 120.0, 80.0, 5)]))
    rows = spark.sql(A.sensor_stats_sql_text("{r}", 6), r=df).collect()
    assert [r.sensor_type for r in rows] == ["pulse", "spo2", "temperature"]  # count desc, then name
    assert rows[0]["count"] == 40


def test_fixed_avg_exact_half_up(spark):
    df = spark.createDataFrame([(1.0000005,), (1.0000015,)], "value double")
    # exact mean 1.000001 -> no rounding; and a tie case 0.0000005 -> rounds up
    assert df.agg(A.avg_col("value", 6)).first()[0] == 1.000001
    tie = spark.createDataFrame([(0.000001,), (0.0,)], "value double")
    assert tie.agg(A.avg_col("value", 6)).first()[0] == 0.000001


def test_drop_nulls_strict_and_required(spark):
    df = readings_df(
        spark,
        [
            (1, "P001", "pulse", 70.0, None, None, 0),
            (2, "P001", "blood_pressure", 0.0, 120.0, 80.0, 1),
            (3, None, "pulse", 70.0, None, None, 2),
            (4, "P001", "pulse", math.nan, None, None, 3),
            (5, "P001", "pulse", None, None, None, 4),
        ],
    )
    strict = C.clean(df, mode="strict")
    assert [r.event_id for r in strict.collect()] == [2]  # T4: only BP rows survive
    required = sorted(r.event_id for r in C.clean(df, mode="required").collect())
    assert required == [1, 2, 4]  # NaN kept (T5), NULL value and NULL patient dropped


def test_null_row_and_duplicates(spark, sample_readings):
    nulls = readings_df(spark, [(None, None, None, None, None, None, None)])
    ten = sample_readings.limit(10)
    assert C.drop_any_null(ten.unionByName(nulls), ["patient_id", "sensor_type", "value", "ts"]).count() == 10
    dup = ten.unionByName(ten.limit(5))
    assert C.distinct_rows(dup).count() == 10
    assert C.dedupe(dup).count() == 10
    assert C.dedupe(dup, keep="first").count() == 10


def test_dedupe_keep_first_is_deterministic(spark):
    df = readings_df(spark, [(2, "P001", "pulse", 71.0, None, None, 0), (1, "P001", "pulse", 70.0, None, None, 0)])
    r = C.dedupe(df, keep="first", order_by=["event_id"]).first()
    assert r.event_id == 1


def test_quality_report(spark):
    df = readings_df(
        spark,
        [
            (1, "P001", "pulse", 25.0, None, None, 0),
            (2, "P001", "pulse", 75.0, None, None, 1),
            (3, "P001", "temperature", 43.0, None, None, 2),
            (4, "P001", "spo2", 65.0, None, None, 3),
            (5, "P001", "blood_pressure", 0.0, 50.0, 160.0, 4),
            (6, "P001", "pulse", None, None, None, 5),
        ],
    )
    r = Q.quality_report(df).first()
    assert r.total_records == 6
    assert r.issues == [
        "Invalid pulse readings: 1",
        "Invalid temperature readings: 1",
        "Invalid SpO2 readings: 1",
        "Invalid systolic readings: 1",
        "Invalid diastolic readings: 1",
    ]
    clean = readings_df(spark, [(1, "P001", "pulse", 75.0, None, None, 0)])
    assert Q.quality_report(clean).first().issues == []


def test_alerts(spark):
    df = readings_df(
        spark,
        [
            (1, "P001", "pulse", 55.0, None, None, 0),
            (2, "P001", "pulse", 105.0, None, None, 1),
            (3, "P001", "pulse", 110.0, None, None, 2),
            (4, "P001", "spo2", 90.0, None, None, 3),
            (5, "P001", "blood_pressure", 0.0, 150.0, 80.0, 4),
        ],
    )
    assert [r.alert for r in Q.alerts(df).collect()] == [
        "Low pulse: 1 readings below normal",
        "High pulse: 2 readings above normal",
        "Low spo2: 1 readings below normal",
    ]
    assert [r.alert for r in Q.alerts_bp(df).collect()] == ["High systolic: 1 readings above normal"]


def test_histogram_edges(spark):
    rows = [(i, "P001", "pulse", float(60 + i), None, None, i) for i in range(31)]
    rows.append((99, "P001", "spo2", 97.0, None, None, 40))
    h = A.histogram(readings_df(spark, rows), bins=30)
    pulse = {r.bin: r["count"] for r in h.filter("sensor_type = 'pulse'").collect()}
    assert sum(pulse.values()) == 31 and max(pulse) == 29 and pulse[29] == 2  # max falls in the last bin
    assert [(r.bin, r["count"]) for r in h.filter("sensor_type = 'spo2'").collect()] == [(0, 1)]  # width 0


def test_sensor_distribution_and_kpis(spark, sample_readings):
    d = {r.sensor_type: r.share_pct for r in A.sensor_distribution(sample_readings, 6).collect()}
    assert abs(sum(d.values()) - 100.0) < 1e-9 and d["pulse"] == 40.0
    k = A.kpis(sample_readings, "2024-03-01 12:01:00").first()
    assert (k.total_readings, k.patients, k.sensor_types) == (100, 4, 3)
    assert 35 <= k.age_seconds <= 36


def test_minute_buckets(spark):
    # same clock minute on two different days: merged by HH:mm, split by true minute
    df = readings_df(spark, [(1, "P001", "pulse", 70.0, None, None, 0), (2, "P001", "pulse", 70.0, None, None, 86400)])
    assert [tuple(r) for r in A.per_clock_minute(df).collect()] == [("12:00", 2)]
    assert A.per_minute(df).count() == 2


def test_payload_size(spark):
    df = readings_df(spark, [(1, "P001", "pulse", 75.0, None, None, 0)])
    r = A.payload_size(df).first()
    # {"patient_id":"P001","sensor_type":"pulse","value":75.0,"timestamp":1709294400} + newline
    assert r.json_bytes == len('{"patient_id":"P001","sensor_type":"pulse","value":75.0,"timestamp":1709294400}') + 1
    assert r.binary_bytes == 8 + 4 + 8 + 5 + 16


def test_dedupe_keep_first_nulls_last_and_hot_key(spark):
    rows = [(i, "P001", "pulse", float(100 - i) if i % 7 else None, None, None, 0) for i in range(1, 200)]
    df = readings_df(spark, rows)
    r = C.dedupe(df, keep="first", order_by=["value", "event_id"]).collect()
    assert len(r) == 1 and r[0].value == min(float(100 - i) for i in range(1, 200) if i % 7)
    r2 = C.dedupe(df, keep="first", order_by=["event_id"]).first()
    assert r2.event_id == 1 and r2.value == 99.0
    plan = C.dedupe(df, keep="first")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_value_stats_empty_gives_zeros(spark):
    empty = readings_df(spark, [(1, "P001", "pulse", 70.0, None, None, 0)]).limit(0)
    r = A.value_stats(empty, 6).first()
    assert (r["count"], r["avg"], r["min"], r["max"]) == (0, 0.0, 0.0, 0.0)


def test_counts_per_patient_and_sensor(sample_readings):
    assert {r.patient_id: r["count"] for r in A.count_per_patient(sample_readings).collect()} == {w + "-17": 25 for w in "ABCD"}
    got = {r.sensor_type: (r["count"], r.avg_value) for r in A.count_avg_per_sensor(sample_readings, 6).collect()}
    assert got["spo2"] == (30, 95.625)


def test_ingest_stats(spark):
    df = readings_df(spark, [(i, "P001", "pulse", 70.0, None, None, i * 2.0) for i in range(11)])
    r = A.ingest_stats(df).first()
    assert (r.num_readings, r.duration_seconds, r.readings_per_second) == (11, 20.0, 0.55)


def test_output_counts(spark):
    from vitalis.operators import windows as W
    df = readings_df(spark, [(1, "P001", "pulse", 70.0, None, None, 0.5), (2, "P002", "pulse", 71.0, None, None, 1.0)])
    got = {(r.kind, r.window_start.second) : r["count"] for r in A.output_counts(df, W.tumbling(df, "5 seconds"), "5 seconds").collect()}
    assert got == {("raw", 0): 2, ("agg", 5): 2}  # aggregates are emitted at their window end


def test_shards(spark, sample_readings):
    from vitalis.operators import shards as X
    assert X.assignment(3) == {"pulse": 0, "temperature": 1, "spo2": 2, "blood_pressure": 2}
    assert X.assignment(1) == {"pulse": 0, "temperature": 0, "spo2": 0, "blood_pressure": 0}
    assert X.sensors_of_shard(1, 6) == ["pulse"] and X.sensors_of_shard(0, 6) == []  # more shards than sensors
    got = {(r.shard_id, r.sensor_type): r["count"] for r in X.shard_counts(sample_readings, 3).collect()}
    assert got == {(0, "pulse"): 40, (1, "temperature"): 30, (2, "spo2"): 30}
    assert X.restrict_to_shard(sample_readings, 2, 3).count() == 30
    tp = X.shard_throughput(sample_readings, 2, "1 hour").collect()
    assert sum(r.processed for r in tp) == 100


def test_ordering_reports(spark, sample_readings):
    from vitalis.operators import report as O
    last = [r.event_id for r in O.last_rows(sample_readings, 5).collect()]
    assert last == [99, 98, 97, 96, 95]
    rows = spark.sql(A.patient_stats_sql_text("{t}"), t=sample_readings).collect()
    assert [r.patient_id for r in rows] == ["A-17", "B-17", "C-17", "D-17"]  # readings desc, then id
