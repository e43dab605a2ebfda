"""Structured Streaming forms: batch = stream on closed windows, late rows, dedup."""

import os
import time

import pyarrow as pa
import pyarrow.parquet as pq

from vitalis.operators import windows as W
from vitalis.session import scratch_path
from vitalis.streaming import stream as S
from vitalis.sources.readings import readings_from_events
from tests.conftest import BASE


def _events(rows):
    return pa.table(
        {
            "event_id": pa.array([r[0] for r in rows], pa.int64()),
            "ts": pa.array([pa.scalar(int((BASE + r[1]) * 1e6), pa.timestamp("us")).as_py() for r in rows], pa.timestamp("us")),
            "user_id": pa.array([r[2] for r in rows], pa.int64()),
            "event_type": pa.array([r[3] for r in rows], pa.string()),
            "value": pa.array([r[4] for r in rows], pa.float64()),
            "props": pa.array(["{}"] * len(rows), pa.string()),
        }
    )


def _write(d, name, rows):
    pq.write_table(_events(rows), os.path.join(d, name))
    time.sleep(1.1)  # file streams pick files up in modification-time order


def test_stream_tumbling_equals_batch_on_closed_windows(spark):
    d = scratch_path(spark, "t-src").replace("file:", "")
    os.makedirs(d)
    rows = [(i, i * 1.7, i % 3, ["click", "view", "purchase"][i % 3], float(40 + i % 30)) for i in range(60)]
    _write(d, "events-1.parquet", rows[:30])
    _write(d, "events-2.parquet", rows[30:])
    stream = S.readings_stream(spark, d, glob="events-*.parquet", max_files_per_trigger=1)
    out = S.run_to_table(S.tumbling_stream(stream, "5 seconds", "10 seconds", 6), "t-tumbling")
    batch = W.tumbling(readings_from_events(spark.read.parquet(d), instant=True), "5 seconds", digits=6)
    newest = max(r[1] for r in rows if r[3] != "purchase")  # watermark follows the scalar rows
    from pyspark.sql import functions as F
    cutoff = F.timestamp_seconds(F.lit(BASE + newest - 10))
    closed = batch.filter(F.col("window_end") <= cutoff)
    assert out.count() == closed.count() > 0
    assert out.exceptAll(closed).count() == 0


def test_late_row_is_dropped(spark):
    d = scratch_path(spark, "t-late").replace("file:", "")
    os.makedirs(d)
    # Spark drops a row as late against the watermark of the previous batch,
    # so the late row comes two batches after the rows that moved the watermark.
    _write(d, "events-1.parquet", [(1, 0.0, 1, "click", 50.0), (2, 100.0, 1, "click", 50.0)])
    _write(d, "events-2.parquet", [(4, 200.0, 1, "click", 50.0)])
    _write(d, "events-3.parquet", [(3, 1.0, 1, "click", 90.0), (5, 300.0, 1, "click", 50.0)])  # id 3 is late
    stream = S.readings_stream(spark, d, glob="events-*.parquet", max_files_per_trigger=1)
    out = S.run_to_table(S.tumbling_stream(stream, "5 seconds", "10 seconds"), "t-late")
    first = out.orderBy("window_start").first()
    assert (first["count"], first["max"]) == (1, 75.0)  # value 50 + 25; the late 90 never counted


def test_dedup_stream(spark):
    d = scratch_path(spark, "t-dedup").replace("file:", "")
    os.makedirs(d)
    rows = [(i, float(i), 1, "click", 50.0) for i in range(10)]
    _write(d, "events-1.parquet", rows)
    _write(d, "events-2.parquet", rows[:5])
    stream = S.readings_stream(spark, d, glob="events-*.parquet", max_files_per_trigger=1)
    out = S.run_to_table(S.dedup_stream(stream, "1 minute"), "t-dedup")
    assert out.count() == 10


def test_hop_stream_runs(spark):
    d = scratch_path(spark, "t-hop").replace("file:", "")
    os.makedirs(d)
    _write(d, "events-1.parquet", [(i, i * 2.0, 1, "click", float(i)) for i in range(40)])
    stream = S.readings_stream(spark, d, glob="events-*.parquet")
    out = S.run_to_table(S.hop_stream(stream, "30 seconds", "5 seconds", "5 seconds", 6), "t-hop").collect()
    assert out and all(r.window_end.timestamp() - r.window_start.timestamp() == 30 for r in out)


def test_message_stream_keeps_bad_lines_and_stamps_arrival(spark):
    import json
    d = scratch_path(spark, "t-msg").replace("file:", "")
    os.makedirs(d)
    with open(os.path.join(d, "m1.json"), "w") as f:
        f.write(json.dumps({"patient_id": "P001", "sensor_type": "pulse", "value": 75.0, "timestamp": 1.0}) + "\n")
        f.write("{broken\n")
    stream = S.message_stream(spark, d)
    out = S.run_to_table(stream, "t-msg")
    rows = out.collect()
    assert len(rows) == 2
    assert sum(r._corrupt_record is not None for r in rows) == 1
    assert all(r._received_at is not None and r._received_timestamp > 0 for r in rows)


def test_progress_summary_and_publish(spark):
    d = scratch_path(spark, "t-pub").replace("file:", "")
    os.makedirs(d)
    _write(d, "events-1.parquet", [(i, float(i), 1, "click", 50.0) for i in range(5)])
    q = S.publish_stream(S.readings_stream(spark, d, glob="events-*.parquet"))
    q.awaitTermination()
    p = S.progress_summary(q)
    assert p["input_rows"] == 5


def test_exact_trailing_stream_equals_batch_across_batches(spark):
    from vitalis.streaming.state import trailing_stream_exact
    d = scratch_path(spark, "t-exact").replace("file:", "")
    os.makedirs(d)
    rows = [(i, (i // 2) * 9.0, i % 3, "click" if i % 4 else "view", float(i % 11)) for i in range(80)]  # pairs of peers
    _write(d, "events-1.parquet", rows[:40])
    _write(d, "events-2.parquet", rows[40:])
    stream = S.readings_stream(spark, d, glob="events-*.parquet", max_files_per_trigger=1)
    out = S.run_to_table(trailing_stream_exact(stream, 30 * 1_000_000, "1 hour", 6), "t-exact")
    batch = W.trailing(readings_from_events(spark.read.parquet(d), instant=True), 30 * 1_000_000, digits=6)
    cols = ["event_id", "count", "avg", "min", "max"]
    assert out.count() == 80
    assert out.select(cols).exceptAll(batch.select(cols)).count() == 0


def test_tagged_streams_one_table(spark):
    d = scratch_path(spark, "t-tag").replace("file:", "")
    os.makedirs(d)
    _write(d, "events-1.parquet", [(i, i * 3.0, 1, "click", 50.0) for i in range(20)])
    raw = S.readings_stream(spark, d, glob="events-*.parquet")
    agg = S.tumbling_stream(S.readings_stream(spark, d, glob="events-*.parquet"), "5 seconds", "5 seconds")
    path, qs = S.tagged_streams(raw, agg)
    for q in qs:
        q.awaitTermination()
    out = spark.read.parquet(path)
    kinds = {r.kind: r["count"] for r in out.groupBy("kind").count().collect()}
    assert kinds["raw"] == 20 and kinds["agg"] > 0


def test_cluster_settings():
    from vitalis.session import cluster_settings
    c = cluster_settings(4000, input_bytes=100 * 10**12)
    assert int(c["spark.sql.shuffle.partitions"]) >= 12000


def test_kpis_stream_matches_batch_counts(spark):
    from pyspark.sql import functions as F
    d = scratch_path(spark, "t-kpi").replace("file:", "")
    os.makedirs(d)
    rows = [(i, i * 1.3, i % 7, ["click", "view", "signup", "purchase"][i % 4], 50.0) for i in range(120)]
    _write(d, "events-1.parquet", rows)
    out = S.run_to_table(S.kpis_stream(S.readings_stream(spark, d, glob="events-*.parquet"), "1 minute", "5 seconds"), "t-kpi")
    got = {r.window_start: (r.total_readings, r.patients, r.sensor_types) for r in out.collect()}
    batch = readings_from_events(spark.read.parquet(d), instant=True).groupBy(F.window("ts", "1 minute").alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("patient_id").alias("p"), F.countDistinct("sensor_type").alias("s"))
    want = {r.w.start: (r.n, r.p, r.s) for r in batch.collect()}
    assert got and all(got[k] == want[k] for k in got)  # closed windows only; small sets are exact in HLL++


def test_update_mode_upsert_log_equals_batch(spark):
    from pyspark.sql import functions as F
    d = scratch_path(spark, "t-upsert").replace("file:", "")
    os.makedirs(d)
    rows = [(i, i * 2.5, i % 3, "click", float(40 + i)) for i in range(40)]
    _write(d, "events-1.parquet", rows[:20])
    _write(d, "events-2.parquet", rows[15:])  # overlaps: later batches update earlier windows
    hop = S.hop_stream(S.readings_stream(spark, d, glob="events-*.parquet", max_files_per_trigger=1),
                       "30 seconds", "10 seconds", "1 hour", 6)
    path, q = S.upsert_log_stream(hop, "t-upsert")
    q.awaitTermination()
    assert spark.read.parquet(path).select("batch_id").distinct().count() >= 2
    latest = S.read_latest(spark, path, ["patient_id", "sensor_type", "window_start"])
    data = readings_from_events(spark.read.parquet(d), instant=True)
    batch = data.groupBy(F.window("ts", "30 seconds", "10 seconds").alias("w"), "patient_id", "sensor_type").agg(
        F.count(F.lit(1)).alias("count"))
    want = {(r.patient_id, r.sensor_type, r.w.start): r["count"] for r in batch.collect()}
    got = {(r.patient_id, r.sensor_type, r.window_start): r["count"] for r in latest.collect()}
    assert got == want


def _folder(spark, name):
    d = scratch_path(spark, name).replace("file:", "")
    os.makedirs(d)
    return d


ROWS = [(i, i * 1.7, i % 3, ["click", "view", "purchase"][i % 3], float(40 + i % 30)) for i in range(80)]


def test_streams_read_a_table_of_part_files(spark):
    d = _folder(spark, "t-parts")
    os.makedirs(f"{d}/events.parquet")
    for k in range(4):
        _write(f"{d}/events.parquet", f"part-{k}.parquet", ROWS[20 * k : 20 * k + 20])
    stream = S.readings_stream(spark, d, max_files_per_trigger=1)
    out = S.updated(S.tumbling_stream(stream, "5 seconds", "10 seconds", 6), "t-parts", ["patient_id", "sensor_type", "window_start"])
    batch = W.tumbling(readings_from_events(spark.read.parquet(f"{d}/events.parquet"), instant=True), "5 seconds", digits=6)
    assert out.count() == batch.count() > 0 and out.exceptAll(batch).count() == 0  # the last windows included


def test_a_stream_started_again_resumes(spark):
    d, base = _folder(spark, "t-again"), scratch_path(spark, "t-again-out")

    def run():
        stream = S.readings_stream(spark, d, glob="events-*.parquet", max_files_per_trigger=1)
        return S.updated(S.tumbling_stream(stream, "5 seconds", "10 seconds", 6), "x", ["patient_id", "sensor_type", "window_start"], base=base)

    _write(d, "events-1.parquet", ROWS[:30])
    run()
    _write(d, "events-2.parquet", ROWS[30:])
    out = run()
    batch = W.tumbling(readings_from_events(spark.read.parquet(d), instant=True), "5 seconds", digits=6)
    assert out.count() == batch.count() and out.exceptAll(batch).count() == 0


def test_exact_trailing_stream_sees_whole_frames_of_late_rows(spark):
    from vitalis.streaming.state import trailing_stream_exact

    d = _folder(spark, "t-order")
    times = [5.0, 40.0, 34.0, 70.0, 62.0, 66.0]  # 34, 62 and 66 come late, within the delay
    for k, t in enumerate(times):
        _write(d, f"events-{k}.parquet", [(k, t, 1, "click", 50.0 + k)])
    stream = S.readings_stream(spark, d, glob="events-*.parquet", max_files_per_trigger=1)
    got = {r.event_id: r for r in S.run_to_table(trailing_stream_exact(stream, 30 * 1_000_000, "10 seconds", 6), "t-order").collect()}
    for k, t in enumerate(times):
        seen = [j for j, u in enumerate(times) if j <= k and t - 30 < u <= t]  # what had come by then
        assert got[k]["count"] == len(seen) and got[k]["max"] == max(75.0 + j for j in seen)


def test_reference_shaped_messages_reach_the_windows(spark):
    import json

    from tests.conftest import sample_records

    d = _folder(spark, "t-shape")
    with open(os.path.join(d, "m.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in sample_records(40)) + "\n")
    out = S.updated(S.tumbling_stream(S.message_stream(spark, d), "5 seconds", "10 seconds"), "t-shape", ["patient_id", "sensor_type", "window_start"])
    assert out.agg({"count": "sum"}).first()[0] == 40


def test_snapshot_stream_equals_the_window(spark):
    d = _folder(spark, "t-snap")
    _write(d, "events-1.parquet", ROWS)
    snap = S.updated(S.snapshot_stream(S.readings_stream(spark, d, glob="events-*.parquet"), "30 seconds", "30 seconds"), "t-snap", ["window_start"])
    first = snap.orderBy("window_start").first()
    held = [r for r in ROWS if r[1] < 30]
    assert first["count"] == len(held) and first.patient_ids == ["P000", "P001", "P002"] and first.window_duration == held[-1][1]
