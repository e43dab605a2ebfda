"""Sources and sinks: JSON lines, Parquet, SQL on a path, named data sets, hand-offs."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from vitalis.session import scratch_path
from vitalis.sources import catalog
from vitalis.sources import files as S
from vitalis.sources import sinks as K
from vitalis.schema import TRANSPORT_SCHEMA
from tests.conftest import BASE, readings_df, sample_records


def _write_lines(lines):
    d = tempfile.mkdtemp(prefix="vitalis-jsonl-")
    p = os.path.join(d, "data.jsonl")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_jsonl_two_records_blank_line(spark):
    p = _write_lines([
        json.dumps({"patient_id": "K-3", "sensor_type": "spo2", "value": 93.5, "timestamp": BASE}),
        "",
        json.dumps({"patient_id": "K-9", "sensor_type": "pulse", "value": 58.25}),
    ])
    df = S.read_jsonl(spark, p)
    got = sorted((r.patient_id, r.sensor_type, r.value, r.timestamp, r.ts is None) for r in df.collect())
    assert got == [("K-3", "spo2", 93.5, BASE, False), ("K-9", "pulse", 58.25, None, True)]


def test_jsonl_bad_line_failfast_and_permissive(spark):
    p = _write_lines([json.dumps({"patient_id": "K-4", "sensor_type": "pulse", "value": 64.0}), "{not json", ""])
    with pytest.raises(Exception):
        S.read_jsonl(spark, p).collect()
    good, bad = S.split_corrupt(S.read_jsonl(spark, p, mode="PERMISSIVE"))
    assert good.count() == 1 and bad.count() == 1


def test_missing_file_gives_empty(spark):
    df = S.read_jsonl_or_empty(spark, "/nonexistent/vitalis/file.jsonl")
    assert df.count() == 0 and "patient_id" in df.columns


def test_epoch_conversion_keeps_fraction(spark):
    p = _write_lines([json.dumps({"patient_id": "K-5", "sensor_type": "pulse", "value": 64.0, "timestamp": 1700000321.7})])
    r = S.read_jsonl(spark, p).select(F.unix_micros("ts").alias("us")).first()
    assert r.us == 1700000321700000


def test_jsonl_round_trip(spark):
    recs = sample_records(20)
    p = _write_lines([json.dumps(r) for r in recs])
    df = S.read_jsonl(spark, p)
    assert df.count() == 20
    out = scratch_path(spark, "t-jsonl")
    K.write_jsonl(df, out)
    back = S.read_jsonl(spark, out)
    assert back.count() == 20
    assert sorted(r.timestamp for r in back.collect()) == sorted(r["timestamp"] for r in recs)


def test_parquet_sql_on_path_and_preference(spark, sample_readings):
    out = scratch_path(spark, "t-parquet")
    K.write_parquet(sample_readings, out, partition_by=["sensor_type"])
    df = S.sql_on_parquet(spark, out, "SELECT sensor_type, COUNT(*) AS n FROM {src} WHERE value > 0 GROUP BY sensor_type")
    assert {r.sensor_type: r.n for r in df.collect()} == {"pulse": 40, "temperature": 30, "spo2": 30}
    with pytest.raises(FileNotFoundError):
        S.sql_on_parquet(spark, out + "-missing", "SELECT * FROM {src}")
    assert S.load_preferred(spark, out, "/nonexistent.jsonl").count() == 100
    # partition pruning: the filter on the partition column reaches the scan
    plan = S.read_parquet(spark, out).filter("sensor_type = 'pulse'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sensor_type" in plan


def test_named_datasets(spark, sample_readings):
    ticket = "t_vitalis_named"
    catalog.drop(spark, ticket)
    catalog.put(sample_readings, ticket, {"kind": "readings"})
    catalog.put(sample_readings.limit(10), ticket)
    assert catalog.get(spark, ticket).count() == 110
    info = {r.ticket: r for r in catalog.list_datasets(spark).collect()}
    assert info[ticket].records == 110 and info[ticket].total_bytes > 0
    with pytest.raises(KeyError):
        catalog.get(spark, "t_vitalis_absent")
    catalog.drop(spark, ticket)


def test_messages_round_trip_and_tags(spark, sample_readings):
    transport = sample_readings.select("patient_id", "sensor_type", "value", F.unix_seconds("ts").alias("timestamp"))
    msgs = K.encode_messages(transport, key="patient_id")
    assert msgs.columns == ["key", "value"]
    back = K.decode_messages(msgs, TRANSPORT_SCHEMA)
    assert back.exceptAll(transport).count() == 0 and transport.exceptAll(back).count() == 0
    tagged = K.tagged_output(transport.limit(3), transport.limit(2))
    lines = [r.line for r in tagged.collect()]
    assert sum(x.startswith("[RAW] {") for x in lines) == 3 and sum(x.startswith("[AGG] {") for x in lines) == 2


def test_arrow_handoff_and_batches(spark, sample_readings):
    import pyarrow.parquet as pq

    handed = K.hand_off(sample_readings, scratch_path(spark, "t-arrow"))
    assert pq.read_table(handed.removeprefix("file:")).num_rows == 100
    assert K.report_to_arrow(sample_readings.groupBy("sensor_type").count()).num_rows == 3
    out = scratch_path(spark, "t-batches")
    K.write_batched(sample_readings.coalesce(1), out, 30)
    files = [f for f in os.listdir(out.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) == 4


def test_empty_and_blank_only_files_give_empty_frames(spark):
    p = _write_lines([""])
    df = S.read_jsonl(spark, p)
    assert df.count() == 0 and "patient_id" in df.columns


def test_preference_falls_back_to_jsonl_and_existing_file_reads(spark):
    recs = sample_records(10)
    p = _write_lines([json.dumps(r) for r in recs])
    assert S.load_preferred(spark, "/nonexistent/vitalis.parquet", p).count() == 10
    assert S.read_jsonl_or_empty(spark, p).count() == 10
    with pytest.raises(FileNotFoundError):
        S.load_preferred(spark, "/nonexistent/a.parquet", "/nonexistent/b.jsonl")


def test_reference_shaped_json_flows_through(spark):
    """Four-field records with epoch seconds reach windows, strict cleaning and the analyzer run."""
    from vitalis.operators import clean as C
    from vitalis.operators import windows as W
    from vitalis.plans.analysis import run_analysis

    recs = [*sample_records(20), {"patient_id": "A-17", "sensor_type": "blood_pressure", "value": 0.0, "systolic": 121.0, "diastolic": 79.0, "timestamp": BASE}]
    df = S.read_jsonl(spark, _write_lines([json.dumps(r) for r in recs]))
    assert W.tumbling(df, "5 seconds").agg({"count": "sum"}).first()[0] == 20
    assert [r.sensor_type for r in C.clean(df, "strict").collect()] == ["blood_pressure"]
    assert run_analysis(spark, df)["cleaned"].count() == 21
    out = scratch_path(spark, "t-shape")
    df.select("patient_id", "sensor_type", "value", "timestamp", F.col("ts").alias("datetime")).write.parquet(out)
    assert run_analysis(spark, S.read_parquet(spark, out))["cleaned"].count() == 20


def test_partitioned_round_trip_keeps_types(spark):
    df = readings_df(spark, [(1, "A", "01", 5.0, None, None, 0), (2, "A", None, 6.0, None, None, 1)])
    out = scratch_path(spark, "t-typed")
    K.write_parquet(df, out, partition_by=["sensor_type"])
    assert sorted((r.event_id, r.sensor_type) for r in S.read_parquet(spark, out, df.schema).collect()) == [(1, "01"), (2, None)]


def test_named_sets_quote_and_list_their_own(spark, sample_readings):
    for ticket in ("vital-2024", "t_quoted"):
        catalog.drop(spark, ticket)
        catalog.put(sample_readings, ticket, {"note": "the ward's \\ set"})
    spark.sql("CREATE OR REPLACE TEMP VIEW t_some_view AS SELECT 1 AS x")
    listed = {r.ticket: r.records for r in catalog.list_datasets(spark).collect()}
    assert listed["vital-2024"] == listed["t_quoted"] == 100 and "t_some_view" not in listed
    assert catalog.get(spark, "vital-2024").count() == 100
    for ticket in ("vital-2024", "t_quoted"):
        catalog.drop(spark, ticket)
