"""Panes, state, manifests, expiry, observed metrics, pushed progress and history."""

import json
import math
import pathlib
import time

import pytest
from pyspark.sql import functions as F

from vitalis.operators import clean as C
from vitalis.operators import windows as W
from vitalis.operators.history import History
from vitalis.plans.analysis import run_observed
from vitalis.operators.quality import quality_report
from vitalis.schema import READINGS_SCHEMA, SCALAR_SENSORS
from vitalis.session import scratch_path
from vitalis.sources import catalog, sinks, store
from vitalis.streaming import snapshots
from vitalis.streaming import stream as S
from vitalis.streaming.progress import progress_to
from vitalis.streaming.snapshots import global_trailing_stream
from vitalis.streaming.state import STORE_MB, current_from_state, state_rows, trailing_stream_exact, use_rocksdb_state
from tests.conftest import BASE, readings_df

US = 1_000_000
INF = math.inf
ODD = [70.0, math.nan, 80.0, INF, 5.0, None, 1e30, -INF, 3.0, 1e10, 1e10, 1e12, -1e12, 0.1, 2.5e-9]


def odd_rows(n, step=3.0):
    """Keys with NULL, values of every kind, times that tie."""
    return [(i, None if i % 4 == 0 else f"P{i % 3}", "pulse" if i % 2 else "spo2", ODD[i % len(ODD)], None, None, (i // 2) * step) for i in range(n)]


def as_files(spark, rows, parts):
    """Readings as JSON-free Parquet files, ``parts`` of them, picked up one by one."""
    d = scratch_path(spark, "t-live").replace("file:", "")
    size = -(-len(rows) // parts)
    for k in range(parts):
        readings_df(spark, rows[k * size : (k + 1) * size]).coalesce(1).write.mode("append").parquet(d)
        time.sleep(1.1)
    return d


def stream_of(spark, d):
    return spark.readStream.schema(READINGS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(d)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-12)
    if isinstance(a, (tuple, list)) and isinstance(b, (tuple, list)):
        return len(a) == len(b) and all(same(x, y) for x, y in zip(a, b, strict=True))
    return a == b


def rows_of(df, by):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: repr(r[by]))


# W5


def global_by_hand(rows, window):
    out = {}
    for i, *_, t in rows:
        frame = [r for r in rows if t - window <= r[6] <= t]
        stats = {}
        for sensor in ("pulse", "spo2"):
            v = [0.0 if r[3] is None else r[3] for r in frame if r[2] == sensor]
            stats[sensor] = (len(v), sum(v) / len(v), min((x for x in v if x == x), default=math.nan), math.nan if any(x != x for x in v) else max(v)) if v else None
        out[i] = (t - min(r[6] for r in frame), len(frame), sorted({r[1] or "unknown" for r in frame}), sorted({r[2] for r in frame}), stats)
    return out


@pytest.mark.parametrize("panes", [1, 2, 5, 16])
def test_global_window_by_panes_is_brute_force(spark, panes):
    rows = [(i, f"P{i % 7}", ("pulse", "spo2")[i % 2], float(i % 11), None, None, float((i * i) % 97) / 2 - 20) for i in range(150)]
    want = global_by_hand(rows, 12)
    got = W.global_trailing(readings_df(spark, rows), 12 * US, digits=6, panes=panes).collect()
    assert len(got) == 150
    for r in got:
        d, n, people, sensors, stats = want[r.event_id]
        assert (r.window_duration, r["count"], r.patient_ids, r.sensor_types) == (d, n, people, sensors)
        for s in ("pulse", "spo2"):
            assert (r[s] is None) == (stats[s] is None)
            if stats[s]:
                assert r[s]["count"] == stats[s][0] and math.isclose(r[s]["avg"], stats[s][1], abs_tol=1e-6) and (r[s]["min"], r[s]["max"]) == stats[s][2:]


def test_global_lists_travel_through_no_sort(spark):
    """Odd rows and rows alike give the frames by hand, and no running state holds the patients of a frame."""
    rows = odd_rows(160, 2.0) + odd_rows(40, 2.0) + [(None, "P9", "other", 1.0, None, None, 150.0)] * 2
    want = global_by_hand(rows, 12)
    out = W.global_trailing(readings_df(spark, rows), 12 * US, digits=6)
    got = out.collect()
    assert sorted(repr(r.event_id) for r in got) == sorted(repr(r[0]) for r in rows)
    for r in got:
        d, n, people, *_ = want[r.event_id]
        assert (r.window_duration, r["count"], r.patient_ids) == (d, n, people)
    assert [r.sensor_types for r in got if r.event_id is None] == [["other", "pulse", "spo2"]] * 2
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert [x[:200] for x in plan.splitlines() if "collect_" in x and "windowspecdefinition" in x] == []


def test_global_rows_are_dealt_once_to_their_panes(spark):
    """What a pane's task makes of its rows isn't shuffled to make the running states: there the readings come straight from the scan."""
    out = W.global_trailing(readings_df(spark, odd_rows(40, 2.0)), 12 * US, digits=6)
    lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    ids = next(i for i, x in enumerate(lines) if "Aggregate [" in x and "collect_list" in x and "event_id" in x)
    assert "RepartitionByExpression [_part" in lines[ids + 1]
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    top = max(i for i, x in enumerate(plan) if "Window [" in x and "_upto" in x)  # the running states, above the aggregate of the ids
    end = next(i for i, x in enumerate(plan) if i > top and "collect_list" in x)
    assert depth(plan[top]) < depth(plan[end]) and not any("Exchange" in x for x in plan[top:end])


def test_a_window_that_holds_most_rows_is_many_tasks(spark):
    """90 % of the rows lie in one W; the largest task of the running states gets less than a quarter of them."""
    hot = spark.range(18_000).select((F.col("id") * 1_000_000 + 10**15).alias("_us"))  # 5 hours at one second
    cold = spark.range(2_000).select((F.col("id") * 3_600_000_000 + 2 * 10**15).alias("_us"))
    rows = hot.union(cold).withColumn("n", F.lit(1))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = W._sliding(rows, [], 5 * 3600 * US, True, {"n": (F.sum("n"), W._plus)}, W.PANES)
        sizes = sorted(r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("n").alias("n")).collect())
        whole = W._sliding(rows, [], 5 * 3600 * US, True, {"n": (F.sum("n"), W._plus)})
        most = max(r["n"] for r in whole.groupBy(F.spark_partition_id()).agg(F.count("n").alias("n")).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20_000 and sizes[-1] < 5_000 < most


# W8, W4 from state


@pytest.mark.parametrize("parts", [1, 3])
def test_exact_stream_is_the_batch_window_for_odd_values(spark, parts):
    rows = odd_rows(150) + [(900, "P1", "pulse", 1.0, None, None, None)]
    out = S.run_to_table(trailing_stream_exact(stream_of(spark, as_files(spark, rows, parts)), 30 * US, "1 hour", 6), "t-odd")
    batch = W.trailing(readings_df(spark, rows), 30 * US, digits=6)
    cols = ["event_id", "patient_id", "sensor_type", "ts", "value", "count", "avg", "min", "max"]
    a, b = rows_of(out.select(cols), 0), rows_of(batch.select(cols), 0)
    assert len(a) == len(b) == 150
    for x, y in zip(a, b, strict=True):
        assert same(x, y), (x, y)


def test_exact_stream_of_large_values(spark):
    """Three readings of 1e10 average 1e10."""
    rows = [(i, "P", "pulse", 1e10, None, None, float(i)) for i in range(3)] + [(3, "P", "pulse", 1e14, None, None, 3.0)]
    out = S.run_to_table(trailing_stream_exact(stream_of(spark, as_files(spark, rows, 1)), 30 * US, "1 hour", 6), "t-large")
    assert [r["avg"] for r in out.orderBy("event_id").collect()] == [1e10, 1e10, 1e10, (3e10 + 1e14) / 4]


def test_exact_stream_resumes_after_a_restart(spark):
    rows = odd_rows(120)
    d, base = as_files(spark, rows[:60], 2), scratch_path(spark, "t-restart")
    S.run_to_table(trailing_stream_exact(stream_of(spark, d), 30 * US, "1 hour", 6), "t", base=base)
    readings_df(spark, rows[60:]).coalesce(1).write.mode("append").parquet(d)
    out = S.run_to_table(trailing_stream_exact(stream_of(spark, d), 30 * US, "1 hour", 6), "t", base=base)
    batch = W.trailing(readings_df(spark, rows), 30 * US, digits=6)
    a, b = rows_of(out.select("event_id", "count", "avg", "min", "max"), 0), rows_of(batch.select("event_id", "count", "avg", "min", "max"), 0)
    assert len(a) == 120 and all(same(x, y) for x, y in zip(a, b, strict=True))


def test_panes_leave_the_state_and_the_current_window_stays(spark):
    rows = [(i, "old" if i < 20 else "new", "pulse", float(i), None, None, i * 10.0) for i in range(100)]
    d, kept = as_files(spark, rows, 4), {}
    for keep in (False, True):
        base = scratch_path(spark, "t-state")
        S.run_to_table(trailing_stream_exact(stream_of(spark, d), 30 * US, "1 second", 6, buckets=2, keep_current=keep), "t", base=base)
        kept[keep] = f"{base}/_checkpoint"
    assert state_rows(spark, kept[False]).count() <= 8
    held = state_rows(spark, kept[True])
    assert held.filter("patient_id = 'old'").count() == 3 and held.count() <= 12
    got = rows_of(current_from_state(spark, kept[True], 30 * US, 6), 0)
    want = rows_of(W.trailing_current(readings_df(spark, rows), 30 * US, digits=6), 0)
    assert got == want and len(got) == 2


# W5 on a stream, A9


@pytest.mark.parametrize("panes", [1, 3])
def test_global_stream_is_the_batch_window_on_closed_time(spark, panes):
    rows = odd_rows(160, 2.0)
    out = S.run_to_table(global_trailing_stream(stream_of(spark, as_files(spark, rows, 3)), 12 * US, "10 seconds", 6, panes), "t-global")
    newest, pane = max(r[6] for r in rows) + BASE, 12 / panes
    batch = W.global_trailing(readings_df(spark, rows), 12 * US, digits=6).drop("event_id")
    want = {r.ts: r for r in batch.collect() if (r.ts.timestamp() // pane + 1) * pane <= newest - 10}
    got = {r.ts: r for r in out.collect()}
    assert len(got) == out.count() == len(want) > 40
    for t, r in got.items():
        assert all(same(r[c], want[t][c]) for c in out.columns), (r, want[t])


def test_state_stores_share_their_memory(spark):
    """Write buffers and cache of all stores of an executor are bounded together; what the session says stays."""
    keys = [f"spark.sql.streaming.stateStore.rocksdb.{x}" for x in ("boundedMemoryUsage", "maxMemoryUsageMB")]
    before = [spark.conf.get(k, None) for k in keys]
    try:
        for k in keys:
            spark.conf.unset(k)
        use_rocksdb_state(spark)
        assert [spark.conf.get(k, None) for k in keys] == ["true", str(STORE_MB)]
        spark.conf.set(keys[1], "99")
        use_rocksdb_state(spark)
        assert spark.conf.get(keys[1]) == "99"
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_global_stream_groups_hold_one_sensor(spark):
    """The state of the first stage has one sensor's numbers a row."""
    out = global_trailing_stream(stream_of(spark, as_files(spark, odd_rows(4), 1)), 12 * US, "10 seconds", 6, 1)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert [x.count("sum(") for x in plan.splitlines() if "Aggregate [" in x and "_p#" in x] == [2]


def test_global_stream_holds_its_readings_once(spark):
    """One aggregate holds the readings; no row of a pane's total, with its patients, goes to the second stage, and none has a column per sensor."""
    out = global_trailing_stream(stream_of(spark, as_files(spark, odd_rows(4), 1)), 12 * US, "10 seconds", 6, 3)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert len([x for x in plan.splitlines() if "Aggregate [" in x]) == 1 and "collect_set" not in plan
    assert not any(f"mx_{s}" in x for x in plan.splitlines() for s in SCALAR_SENSORS if "explode" in x)


def test_global_stream_makes_long_lists_a_part_at_a_time(monkeypatch):
    """The frames of a hundred times and 300 patients, on both sides of a block's start, sums beyond 64 bits included."""
    monkeypatch.setattr(snapshots, "NAMES", 3_000)
    made, n = snapshots.ClosedPanes(60 * US, 20 * US), 300
    us = [(60 + i // 3) * US for i in range(n)]  # the last 60 s of one block and 40 s of the next
    large = [str(10**20 + i) if i % 2 else "" for i in range(n)]
    rows = [us, [f"P{i}" for i in range(n)], ["pulse"] * n, [1] * n, [0 if x else i for i, x in enumerate(large)], large, [math.nan] * n, [float(i) for i in range(n)], [float(i) for i in range(n)]]
    frames = list(made._snapshots(2, [tuple(rows)], 6, 8))
    assert len(frames) > 3 and all(sum(len(x) for x in f.patients) <= 3_000 for f in frames)
    got = [r for f in frames for r in f.itertuples()]
    assert [r.us for r in got] == sorted(set(us[180:]))
    for r in got:
        k = [i for i in range(n) if r.us - 60 * US <= us[i] <= r.us]
        assert (r.first, r.count, sorted(r.patients), list(r.sensors)) == (us[k[0]], len(k), sorted(f"P{i}" for i in k), ["pulse"])
        assert (r.n_pulse, r.s_pulse, r.mn_pulse, r.mx_pulse) == (len(k), sum(int(large[i] or i) for i in k), k[0], k[-1])
        assert r.n_spo2 == 0


def test_files_of_long_lists_are_small(spark):
    """Lists that hardly differ from row to row: the files have a tenth of the lists' names at most, and the session's settings stay."""
    before = {k: spark.conf.get(k, None) for k in S.LONG_LISTS}
    names = F.transform(F.sequence(F.col("event_id"), F.col("event_id") + 1_999), lambda x: F.concat(F.lit("P"), (x * 7919 % 100_003).cast("string")))
    rows = readings_df(spark, [(i, "P", "pulse", 1.0, None, None, float(i)) for i in range(400)]).coalesce(1)
    d, sizes = scratch_path(spark, "t-long").replace("file:", ""), {}
    rows.write.parquet(d)
    for long_lists in (False, True):
        base = scratch_path(spark, "t-long").replace("file:", "")
        out = S.run_to_table(stream_of(spark, d).select("event_id", names.alias("l")), "t", base=base, long_lists=long_lists)
        assert out.count() == 400 and out.filter(F.size("l") == 2_000).count() == 400
        sizes[long_lists] = sum(x.stat().st_size for x in pathlib.Path(f"{base}/out").glob("*.parquet"))
    assert sizes[True] < 400 * 2_000 * 6 / 10 and sizes[True] < sizes[False] / 2
    assert {k: spark.conf.get(k, None) for k in S.LONG_LISTS} == before


def test_kpis_of_a_stream_are_exact(spark):
    rows = [(i, f"P{(i * 7919) % 3001}" if i % 50 else None, ("pulse", "spo2", None)[i % 3], 1.0, None, None, i * 0.02) for i in range(9_000)]
    out = S.run_to_table(S.kpis_stream(stream_of(spark, as_files(spark, rows, 2)), "1 minute", "5 seconds"), "t-kpis").orderBy("window_start").collect()
    first = BASE - BASE % 60
    assert len(out) == 2
    for r in out:
        own = [x for x in rows if r.window_start.timestamp() <= BASE + x[6] < r.window_end.timestamp()]
        assert r.window_start.timestamp() >= first
        assert (r.total_readings, r.patients, r.sensor_types) == (len(own), len({x[1] for x in own}), len({x[2] for x in own}))


# S13 - S15


def test_tickets_never_meet(spark, sample_readings):
    tickets = ["Run-1", "run-1", "a-b", "a_x2d_b", "", "x/../y", "ü 'q' \\"]
    for n, t in enumerate(tickets):
        catalog.drop(spark, t)
        catalog.put(sample_readings.limit(n + 1), t, {"n": str(n)})
    listed = {r.ticket: (r.records, r.total_bytes > 0) for r in catalog.list_datasets(spark).collect()}
    for n, t in enumerate(tickets):
        assert catalog.get(spark, t).count() == n + 1 and listed[t] == (n + 1, True) and catalog.metadata(spark, t) == {"n": str(n)}
        catalog.drop(spark, t)
    with pytest.raises(KeyError):
        catalog.get(spark, "Run-1")


def test_a_put_that_fails_adds_nothing(spark, sample_readings):
    t = "t-failing"
    catalog.drop(spark, t)
    catalog.put(sample_readings, t)
    bad = sample_readings.withColumn("value", F.when(F.col("event_id") > 90, F.raise_error(F.lit("no"))).otherwise(F.col("value")).cast("double"))
    with pytest.raises(Exception, match="no"):
        catalog.put(bad, t)
    with pytest.raises(ValueError):
        catalog.put(sample_readings.withColumn("more", F.lit(1)), t)
    catalog.put(sample_readings.limit(0), t)
    assert catalog.get(spark, t).count() == 100
    assert {r.ticket: r.records for r in catalog.list_datasets(spark).collect()}[t] == 100
    catalog.drop(spark, t)


def test_small_puts_become_one(spark, sample_readings):
    t = "t-compact"
    catalog.drop(spark, t)
    for k in range(3):
        catalog.put(sample_readings.filter(F.col("event_id") % 3 == k), t, {f"k{k}": str(k)})
    before = catalog._commits(spark, t)
    assert catalog.compact(spark, t) == 3 and catalog.compact(spark, t) == 1
    assert catalog.get(spark, t).exceptAll(sample_readings).count() == 0 and catalog.get(spark, t).count() == 100
    assert catalog.metadata(spark, t) == {"k0": "0", "k1": "1", "k2": "2"} and len(store.names(spark, f"{catalog._home(spark, t)}/data")) == 1
    # records that a crash left behind don't count
    for r in before:
        store.publish_text(spark, f"{catalog._home(spark, t)}/commits/{r['put']}.json", json.dumps({**r.asDict(), "at": None}) + "\n")
    assert {r.ticket: r.records for r in catalog.list_datasets(spark).collect()}[t] == 100 == catalog.get(spark, t).count()
    catalog.drop(spark, t)


def test_listing_opens_no_data_file(spark, sample_readings):
    catalog.put(sample_readings, "t-list")
    files = catalog.list_datasets(spark).inputFiles()
    assert files and all("/commits/" in f and f.endswith(".json") for f in files)
    catalog.drop(spark, "t-list")


# S12


def test_expired_days_leave_the_store(spark):
    path = scratch_path(spark, "t-expire")
    rows = [(i, "P", "pulse", 1.0, None, None, i * 3600.0) for i in range(24 * 6)] + [(999, "P", "pulse", 1.0, None, None, None)]
    df = readings_df(spark, rows)
    sinks.write_retained(df, path)
    days = [n for n in store.names(spark, path) if n.startswith("date=2")]
    assert len(days) == 7  # from noon to noon
    gone = sinks.expire(spark, path, 24)
    assert gone == days[:5] and sinks.expire(spark, path, 24) == []
    left = spark.read.schema(df.schema).parquet(path)
    assert left.filter("ts IS NULL").count() == 1
    newest = df.agg(F.max("ts")).first()[0]
    assert sinks.retain(left, 24).count() == df.filter(F.col("ts") > F.lit(newest) - F.expr("INTERVAL 24 HOURS")).count() == 24
    sinks.write_retained(df.filter("event_id = 0"), path)  # a late row: its day comes back and goes again
    assert sinks.expire(spark, path, 24) == days[:1]
    assert sinks.expire(spark, scratch_path(spark, "t-none"), 24) == []


def test_a_report_is_small(spark, sample_readings):
    path = sinks.write_report(sample_readings, scratch_path(spark, "t-report"), 100)
    assert spark.read.json(path).count() == 100
    with pytest.raises(ValueError):
        sinks.write_report(sample_readings, path, 99)
    assert not store.exists(spark, path)


def test_sql_on_a_path_with_a_back_tick(spark, sample_readings):
    from vitalis.sources.files import sql_on_parquet

    path = scratch_path(spark, "t-tick") + "/a`b"
    sample_readings.write.parquet(path)
    assert sql_on_parquet(spark, path, "SELECT COUNT(*) AS n FROM {src}").first().n == 100


# V9 + D3 + S7


def test_report_fills_while_the_clean_table_is_written(spark):
    rows = [(i, "P" if i % 7 else None, "pulse", 20.0 + i, None, None, float(i // 2)) for i in range(60)] + [(100, "P", "blood_pressure", 0.0, 300.0, 20.0, 0.0)]
    df = readings_df(spark, rows)
    got = run_observed(spark, df)
    r, plain = got["report"].first(), quality_report(df).first()
    assert (r.total_records, r.issues) == (plain.total_records, plain.issues)
    assert r.cleaned_records == got["cleaned"].count() == C.clean(df).count()
    none = run_observed(spark, df.limit(0))["report"].first()
    assert (none.total_records, none.issues, none.cleaned_records) == (0, [], 0)


def test_observed_analysis_scans_the_input_once(spark):
    path = scratch_path(spark, "t-once")
    readings_df(spark, [(i, "P", "pulse", 1.0 * i, None, None, float(i)) for i in range(50)]).write.parquet(path)
    read = spark.read.schema(READINGS_SCHEMA).parquet(path)
    counter = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            counter.add(b.num_rows)
            yield b

    r = run_observed(spark, read.mapInArrow(counted, read.schema))["report"].first()
    assert r.total_records == 50 == counter.value


# R7


def test_progress_comes_by_itself(spark):
    d = as_files(spark, odd_rows(40), 2)
    path = scratch_path(spark, "t-progress")
    with progress_to(spark, path) as reports:
        q = S.start_to_parquet(stream_of(spark, d), f"{path}-out", f"{path}-check")
        q.awaitTermination()
        assert reports.wait(str(q.runId))
    got = [r for r in reports.table().orderBy("batch_id").collect() if r.run_id == str(q.runId) and r.input_rows]
    assert [r.input_rows for r in got] == [20, 20] and [r.batch_id for r in got] == [0, 1] and all(r.duration_ms > 0 for r in got)


# D1 / D5


def test_history_is_the_batch_clean_of_all_batches(spark):
    rows = [(i % 40, None if i % 9 == 0 else f"P{i % 5}", "pulse", float(i % 40), None, None, None if i % 40 == 7 else float(i % 40)) for i in range(120)]
    path = scratch_path(spark, "t-history")
    h = History(spark, "t_vitalis_history", path, buckets=4)
    spark.sql(f"DROP TABLE IF EXISTS {h.name}")
    counts = [h.add(readings_df(spark, rows[k * 30 : k * 30 + 50]), k).count() for k in range(4)]
    want = C.dedupe(readings_df(spark, rows), keep="any").select(*C.DEDUP_KEY)
    got = h.rows().select(*C.DEDUP_KEY)
    assert got.count() == want.count() == sum(counts) and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    files = len(spark.table(h.name).inputFiles())
    h.compact()
    assert len(spark.table(h.name).inputFiles()) <= 4 < files
    again = h.add(readings_df(spark, rows[90:140]), 3)  # run again after a crash: the same rows, no key twice
    assert again.count() == counts[3] and h.rows().count() == sum(counts) == spark.table(h.name).count()
    spark.sql(f"DROP TABLE {h.name}")


def test_history_is_not_shuffled(spark):
    path = scratch_path(spark, "t-history")
    h = History(spark, "t_vitalis_history_plan", path, buckets=4)
    spark.sql(f"DROP TABLE IF EXISTS {h.name}")
    rows = [(i, f"P{i}", "pulse", 1.0, None, None, float(i)) for i in range(30)]
    h.add(readings_df(spark, rows), 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a long history
    try:
        new = h.new_rows(readings_df(spark, rows), 1)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert new.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = plan.index("SortMergeJoin")
    sides = plan[join:]
    stored = sides[sides.rindex("Sort ["):]
    assert "Exchange" not in stored and "Bucketed: true" in stored
    spark.sql(f"DROP TABLE {h.name}")
