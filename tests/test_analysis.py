"""Analyzer run, dashboard panels, remaining sinks and scalar helpers."""

import os

from pyspark.sql import functions as F

from vitalis.functions import scalar as P
from vitalis.plans.analysis import dashboard_data, run_analysis
from vitalis.session import scratch_path
from vitalis.sources import sinks as K
from vitalis.streaming import stream as S
from tests.conftest import readings_df


def test_run_analysis(spark, sample_readings):
    dirty = sample_readings.unionByName(sample_readings.limit(5)).unionByName(
        readings_df(spark, [(500, None, "pulse", 80.0, None, None, 3)])
    )
    out = run_analysis(spark, dirty)
    assert out["cleaned"].count() == 100
    assert out["quality"].first().total_records == 106
    stats = {r.sensor_type: r["count"] for r in out["sensor_stats_sql"].collect()}
    assert stats == {"pulse": 40, "temperature": 30, "spo2": 30}
    assert {r.patient_id for r in out["patient_stats_sql"].collect()} == {"A-17", "B-17", "C-17", "D-17"}


def test_dashboard_panels(spark, sample_readings):
    d = dashboard_data(sample_readings, "2024-03-01 12:01:00")
    assert d["kpis"].first().total_readings == 100
    assert d["recent"].count() == 20
    assert d["series_pulse"].first().normal_min == 60.0
    assert d["histogram_spo2"].count() >= 1


def test_report_and_retained_sinks(spark, sample_readings):
    rep = scratch_path(spark, "t-report")
    K.write_report(sample_readings.groupBy("sensor_type").count(), rep)
    files = [f for f in os.listdir(rep.replace("file:", "")) if f.endswith(".json")]
    assert len(files) == 1
    ret = scratch_path(spark, "t-retained")
    K.write_retained(sample_readings, ret)
    assert any(x.startswith("date=") for x in os.listdir(ret.replace("file:", "")))
    late = sample_readings.unionByName(readings_df(spark, [(900, "P001", "pulse", 70.0, None, None, -2 * 86400)]))
    assert K.retain(late, 24).count() == 100


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("P001", "blood_pressure", None, 1234567890.5)], "p string, s string, v double, e double")
    k = P.composite_key("p", "s")
    pat, sen = P.split_key(k)
    r = df.select(
        k.alias("k"), pat.alias("pat"), sen.alias("sen"), P.with_default("v", 0.0).alias("v"),
        P.iso_text(P.epoch_to_ts("e")).alias("iso"), P.ts_to_epoch(P.epoch_to_ts("e")).alias("sec"),
        P.patient_code(F.lit(7)).alias("code"), P.round_to(F.lit(36.55), 1).alias("r"),
    ).first()
    assert (r.k, r.pat, r.sen) == ("P001_blood_pressure", "P001", "blood_pressure")  # T1 fixed
    assert (r.v, r.iso, r.sec, r.code, r.r) == (0.0, "2009-02-13T23:31:30.500000", 1234567890, "P007", 36.6)


def test_rocksdb_state_stream(spark):
    from tests.test_stream import _write
    S.use_rocksdb_state(spark)
    try:
        d = scratch_path(spark, "t-rocks").replace("file:", "")
        os.makedirs(d)
        _write(d, "events-1.parquet", [(i, i * 3.0, 1, "click", 50.0) for i in range(20)])
        out = S.run_to_table(S.tumbling_stream(S.readings_stream(spark, d, glob="events-*.parquet"), "5 seconds", "5 seconds"), "t-rocks")
        assert out.count() > 0
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_cli_analyze_jsonl(spark, capsys):
    import json
    import tempfile
    from tests.conftest import sample_records
    from vitalis import __main__ as cli
    d = tempfile.mkdtemp(prefix="vitalis-cli-")
    p = os.path.join(d, "readings.jsonl")
    with open(p, "w") as f:
        f.write("\n".join(json.dumps(r) for r in sample_records(30)) + "\n")
    spark.stop = lambda: None  # keep the shared test session alive
    cli.clear_scratch = lambda s: None  # and what other tests have written
    cli.main(["analyze", p, "--rows", "5"])
    out = capsys.readouterr().out
    assert "== sensor_stats_sql" in out and "pulse" in out


def test_validated_records_as_json_messages_have_expected_keys(spark):
    import json
    from vitalis.operators import quality as Q
    df = readings_df(spark, [(1, "P001", "pulse", 75.0, None, None, 0), (2, "P002", "blood_pressure", 0.0, 120.0, 80.0, 1)])
    scalar = [json.loads(r.value) for r in K.encode_messages(Q.validated_readings(df)).collect()]
    bp = [json.loads(r.value) for r in K.encode_messages(Q.validated_bp(df)).collect()]
    assert set(scalar[0]) == {"patient_id", "sensor_type", "value", "timestamp", "is_valid"}
    assert set(bp[0]) == {"patient_id", "sensor_type", "systolic", "diastolic", "timestamp", "is_valid"}
    assert bp[0]["is_valid"] is True and isinstance(bp[0]["timestamp"], int)


def test_cli_dashboard_on_driver_folder(spark, capsys):
    from vitalis import __main__ as cli
    spark.stop = lambda: None  # keep the shared test session alive
    cli.clear_scratch = lambda s: None  # and what other tests have written
    cli.main(["dashboard", "/root/testdata/sf0.001", "--rows", "3"])
    out = capsys.readouterr().out
    assert "== kpis" in out and "== recent" in out and "== histogram_pulse" in out


def test_scratch_is_cleared(spark, monkeypatch):
    from vitalis import session

    path = scratch_path(spark, "t-clear")
    spark.range(3).write.parquet(path)
    assert os.path.exists(path.replace("file:", ""))
    monkeypatch.setattr(session, "_own_dir", lambda s: path)  # only this test's own folder
    session.clear_scratch(spark)
    assert not os.path.exists(path.replace("file:", ""))


def test_shared_folder_is_needed_on_a_cluster():
    import pytest

    from vitalis import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())
