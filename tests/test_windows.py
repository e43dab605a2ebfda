"""Tumbling and trailing windows, boundaries, peers, skew split, global window."""

from vitalis.operators import windows as W
from tests.conftest import readings_df

US = 1_000_000


def test_sliding_sample(spark):
    rows = [(i, "P001", "pulse", v, None, None, i) for i, v in enumerate([60.0, 70.0, 80.0, 90.0, 100.0])]
    last = W.trailing(readings_df(spark, rows), 30 * US).orderBy("ts").collect()[-1]
    assert (last["count"], last["avg"], last["min"], last["max"]) == (5, 80.0, 60.0, 100.0)
    cur = W.trailing_current(readings_df(spark, rows), 30 * US).first()
    assert (cur["count"], cur["avg"], cur["min"], cur["max"]) == (5, 80.0, 60.0, 100.0)


def test_open_and_closed_lower_bound(spark):
    # exactly 30 s apart: excluded by the open per-key window (T8), included by the closed one
    rows = [(1, "P001", "pulse", 60.0, None, None, 0.0), (2, "P001", "pulse", 80.0, None, None, 30.0),
            (3, "P001", "pulse", 90.0, None, None, 60.000001)]
    df = readings_df(spark, rows)
    open_ = {r.event_id: r["count"] for r in W.trailing(df, 30 * US).collect()}
    closed = {r.event_id: r["count"] for r in W.trailing(df, 30 * US, closed=True).collect()}
    assert open_ == {1: 1, 2: 1, 3: 1}
    assert closed == {1: 1, 2: 2, 3: 1}  # 30 s + 1 us apart is outside even when closed


def test_equal_timestamps_are_peers(spark):
    rows = [(1, "P001", "pulse", 60.0, None, None, 5.0), (2, "P001", "pulse", 80.0, None, None, 5.0)]
    got = {r.event_id: r["count"] for r in W.trailing(readings_df(spark, rows), 30 * US).collect()}
    assert got == {1: 2, 2: 2}


def _brute_trailing(pdf, w_us, closed, keys):
    out = {}
    pdf = pdf.assign(us=pdf.ts.astype("int64") // 1000)
    for _, g in pdf.groupby(keys) if keys else [(None, pdf)]:
        for _, r in g.iterrows():
            lo = r.us - w_us if closed else r.us - w_us + 1
            f = g[(g.us >= lo) & (g.us <= r.us)]
            out[r.event_id] = (len(f), f.value.min(), f.value.max())
    return out


def test_trailing_matches_brute_force_across_buckets(spark):
    # one hot key with many rows spread over several buckets, plus a second key
    rows = [(i, "P001" if i % 4 else "P002", "pulse", float(i % 37), None, None, i * 7.3) for i in range(300)]
    df = readings_df(spark, rows)
    got = {r.event_id: (r["count"], r["min"], r["max"]) for r in W.trailing(df, 30 * US).collect()}
    want = _brute_trailing(df.toPandas(), 30 * US, False, ["patient_id", "sensor_type"])
    assert got == want


def test_global_trailing_matches_brute_force(spark):
    rows = [(i, f"P00{i % 5}", ["pulse", "temperature", "spo2", "blood_pressure"][i % 4], float(i % 50 + 60),
             None, None, i * 4.1) for i in range(200)]
    df = readings_df(spark, rows)
    got = W.global_trailing(df, 30 * US, digits=6).collect()
    pdf = df.toPandas()
    want = _brute_trailing(pdf, 30 * US, True, [])
    pdf = pdf.assign(us=pdf.ts.astype("int64") // 1000)
    for r in got:
        assert r["count"] == want[r.event_id][0]
        me = pdf[pdf.event_id == r.event_id].us.iloc[0]
        frame = pdf[(pdf.us >= me - 30 * US) & (pdf.us <= me)]
        assert r.patient_ids == sorted(frame.patient_id.unique())
        assert r.window_duration == (me - frame.us.min()) / 1e6
        p = frame[frame.sensor_type == "pulse"]
        if len(p):
            assert r.pulse["count"] == len(p) and r.pulse["max"] == p.value.max()
        else:
            assert r.pulse is None


def test_global_trailing_has_no_single_partition_exchange(spark, sample_readings):
    plan = W.global_trailing(sample_readings, 30 * US)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_tumbling_and_bp_patient_id(spark):
    rows = [
        (1, "P001", "pulse", 60.0, None, None, 0.5),
        (2, "P001", "pulse", 80.0, None, None, 4.9),
        (3, "P001", "pulse", 90.0, None, None, 5.0),
        (4, "P001", "blood_pressure", 0.0, 120.0, 80.0, 1.0),
        (5, "P001", "blood_pressure", 0.0, 130.0, 90.0, 2.0),
    ]
    df = readings_df(spark, rows)
    t = W.tumbling(df, "5 seconds").orderBy("window_start").collect()
    assert [(r["count"], r["avg"], r["min"], r["max"]) for r in t] == [(2, 70.0, 60.0, 80.0), (1, 90.0, 90.0, 90.0)]
    assert t[0]["timestamp"] == t[0]["window_end"]
    bp = W.tumbling_bp(df, "5 seconds").first()
    assert bp.patient_id == "P001"  # T1: not 'P001_blood'
    assert (bp["count"], bp.systolic_avg, bp.diastolic_max) == (2, 125.0, 90.0)


def test_window_rows_and_current(spark):
    rows = [(i, "P001", s, 70.0 + i, None, None, i * 10.0) for i, s in enumerate(["pulse", "spo2", "pulse", "temperature", "pulse"])]
    df = readings_df(spark, rows)
    assert sorted(r.event_id for r in W.window_rows(df, 30 * US).collect()) == [1, 2, 3, 4]
    cur = W.window_current(df, 30 * US).first()
    assert (cur["count"], cur.window_duration, cur.sensor_types) == (4, 30.0, ["pulse", "spo2", "temperature"])
    assert cur.pulse["count"] == 2 and cur.pulse["avg"] == 73.0


def test_trailing_keeps_null_keys_and_odd_values(spark):
    import math

    inf = float("inf")
    values = [70.0, math.nan, 80.0, inf, 5.0, None, 1e30, -inf, 3.0]
    rows = [(i, None if i % 3 == 0 else "P", None if i % 2 else "pulse", values[i % 9], None, None, (i // 2) * 7.0) for i in range(120)]
    df = readings_df(spark, rows).fillna("other", ["sensor_type"])
    pdf = [(r.event_id, r.patient_id, r.sensor_type, r.value, r.ts.timestamp()) for r in df.collect()]
    for closed in (False, True):
        for digits in (6, None):
            got = {r.event_id: r for r in W.trailing(df, 30 * US, closed=closed, digits=digits).collect()}
            assert len(got) == 120 == W.trailing(df, 30 * US, digits=digits).count()
            for e, p, s, _, t in pdf:
                frame = [v for _, p2, s2, v, t2 in pdf if (p2, s2) == (p, s) and t2 <= t and (t - t2 <= 30 if closed else t - t2 < 30)]
                known = [v for v in frame if v is not None]
                assert got[e]["count"] == len(frame)
                want = sum(known) / len(known) if known else None
                if want is None:
                    assert got[e]["avg"] is None
                elif math.isnan(want):
                    assert math.isnan(got[e]["avg"])
                else:
                    assert got[e]["avg"] == want or math.isclose(got[e]["avg"], want, rel_tol=1e-6, abs_tol=1e-6)
                if known and not any(math.isnan(v) for v in known):
                    assert (got[e]["min"], got[e]["max"]) == (min(known), max(known))


def test_trailing_current_keeps_null_keys(spark):
    df = readings_df(spark, [(1, None, "pulse", 60.0, None, None, 0), (2, None, "pulse", 70.0, None, None, 5), (3, "P", "pulse", 80.0, None, None, 0)])
    assert {(r.patient_id, r["count"]) for r in W.trailing_current(df, 30 * US).collect()} == {(None, 2), ("P", 1)}


def test_trailing_of_a_dense_key_is_not_quadratic(spark):
    """No sliding frame is left in the plans: every frame starts at its partition's start."""
    df = readings_df(spark, [(1, "P", "pulse", 60.0, None, None, 0)])
    for out in (W.trailing(df, 30 * US, digits=6), W.global_trailing(df, 30 * US, digits=6)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "specifiedwindowframe" in plan
        assert plan.count("specifiedwindowframe") == plan.count("unboundedpreceding$(), currentrow$()")


def test_averages_of_odd_values_are_those_of_avg(spark):
    import math

    from vitalis.functions.stats import avg_col, fixed_avg_sql

    for values, want in (([70.0, math.nan, 80.0], math.nan), ([70.0, float("inf")], float("inf")), ([1e30, 1e30], 1e30), ([None], None), ([1.0, 2.0], 1.5)):
        df = spark.createDataFrame([(v,) for v in values], "value double")
        for got in (df.agg(avg_col("value", 6)).first()[0], df.selectExpr(fixed_avg_sql("value", 6)).first()[0]):
            assert got is want if want is None else got == want or math.isnan(got) and math.isnan(want)
