"""Registered queries: one per operator of the inventory, over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the full
``events`` table (mapped to readings).  Window sizes follow the build plan:
the driver data has minutes between events, so the 5 s / 30 s collector
windows become 1 day / 6 days per key (same 1:6 ratio) and 30 minutes for the
global consumer window; unit tests use the true 5 s / 30 s on fixtures.
Averages are exact fixed-point values at 6 decimals (``fixed_avg``) and
deviations are rounded to 6 decimals, so engines with a different summation
order agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.functions.scalar import composite_key, epoch_to_ts, iso_text, round_to, split_key, ts_to_epoch, ts_to_epoch_float, with_default
from vitalis.functions.validation import register_sql_functions
from vitalis.operators import aggregate as A
from vitalis.operators import clean as C
from vitalis.operators import quality as Q
from vitalis.operators import report as O
from vitalis.operators import shards as X
from vitalis.operators import windows as W
from vitalis.operators.history import History
from vitalis.plans.analysis import run_analysis, run_observed
from vitalis.schema import READING_JSON_SCHEMA, TRANSPORT_SCHEMA
from vitalis.session import prepare, scratch_path
from vitalis.sources import catalog
from vitalis.sources.files import CORRUPT_COLUMN, load_preferred, read_jsonl, read_jsonl_or_empty, read_parquet, split_corrupt
from vitalis.sources.readings import READING_COLUMNS, dirty_readings, dirty_readings_from, readings
from vitalis.sources.sinks import (
    decode_messages,
    encode_messages,
    expire,
    hand_off,
    retain,
    tagged_output,
    write_batched,
    write_jsonl,
    write_parquet,
    write_report,
    write_retained,
)
from vitalis.streaming import stream as S
from vitalis.streaming.progress import progress_to
from vitalis.streaming.snapshots import global_trailing_stream
from vitalis.streaming.state import current_from_state, trailing_stream_exact

# Registry parameters (see module docstring).
DIGITS = 6
DAY = "1 day"
US_DAY = 86_400_000_000
TRAILING_US = 6 * US_DAY
GLOBAL_US = 30 * 60 * 1_000_000
KPI_AS_OF = "2024-02-01 00:00:00"
SHARDS = 3
STREAM_DELAY = "1 hour"

Query = Callable[[SparkSession, str], DataFrame]

MESSAGE = T.StructType().add("event_id", "long").add("patient_id", "string").add("sensor_type", "string").add("value", "double")


def _r(spark: SparkSession, sf_dir: str, sensors=None, exclude=None) -> DataFrame:
    return readings(spark, sf_dir, sensors=sensors, exclude=exclude)


SCALAR = dict(exclude=("blood_pressure",))
BP = dict(sensors=("blood_pressure",))


def _d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_readings(spark, sf_dir)


# -- A3 / A4 through the SQL API ----------------------------------------------


def q_sensor_stats_sql(spark, sf_dir):
    return spark.sql(A.sensor_stats_sql_text("{readings}", DIGITS), readings=_r(spark, sf_dir))


def q_patient_stats_sql(spark, sf_dir):
    return spark.sql(A.patient_stats_sql_text("{readings}"), readings=_d(spark, sf_dir))


def q_sql_on_parquet(spark, sf_dir):
    prepare(spark)
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    return spark.sql(
        f"""SELECT event_type, COUNT(*) AS count, AVG(value) AS avg_value
            FROM parquet.`{path}` WHERE value > 0 GROUP BY event_type"""
    )


def q_sql_validate(spark, sf_dir):
    register_sql_functions(spark)
    return spark.sql(
        """SELECT event_id, sensor_type,
                  coalesce(CASE sensor_type
                    WHEN 'pulse' THEN validate_pulse(value)
                    WHEN 'temperature' THEN validate_temperature(value)
                    WHEN 'spo2' THEN validate_spo2(value)
                    WHEN 'blood_pressure' THEN
                      CASE WHEN validate_systolic(systolic).is_valid THEN validate_diastolic(diastolic)
                           ELSE validate_systolic(systolic) END
                  END.error_code, 0) AS error_code,
                  CASE sensor_type
                    WHEN 'pulse' THEN status_pulse(value)
                    WHEN 'temperature' THEN status_temperature(value)
                    WHEN 'spo2' THEN status_spo2(value)
                    WHEN 'blood_pressure' THEN concat(status_systolic(systolic), '/', status_diastolic(diastolic))
                  END AS status
           FROM {readings}""",
        readings=_r(spark, sf_dir),
    )


# -- aggregates ----------------------------------------------------------------

def q_sensor_stats(spark, sf_dir):
    return A.by_sensor(_r(spark, sf_dir), DIGITS)


def q_patient_stats(spark, sf_dir):
    return A.by_patient(_d(spark, sf_dir))


def q_patient_summary(spark, sf_dir):
    return A.patient_summary(_d(spark, sf_dir))


def q_pulse_stats(spark, sf_dir):
    return A.filtered_stats(_r(spark, sf_dir, sensors=("pulse",)), "pulse", DIGITS)


def q_patient_counts(spark, sf_dir):
    return A.count_per_patient(_r(spark, sf_dir))


def q_sensor_count_avg(spark, sf_dir):
    return A.count_avg_per_sensor(_r(spark, sf_dir), DIGITS)


def q_value_stats(spark, sf_dir):
    return A.value_stats(W.scalar_readings(_r(spark, sf_dir, **SCALAR)), DIGITS)


def q_sensor_distribution(spark, sf_dir):
    return A.sensor_distribution(_r(spark, sf_dir), DIGITS)


def q_per_clock_minute(spark, sf_dir):
    return A.per_clock_minute(_r(spark, sf_dir))


def q_per_minute(spark, sf_dir):
    return A.per_minute(_r(spark, sf_dir))


def q_histogram(spark, sf_dir):
    return A.histogram(_r(spark, sf_dir, sensors=("pulse", "temperature", "spo2")), digits=DIGITS)


def q_kpis(spark, sf_dir):
    return A.kpis(_d(spark, sf_dir), KPI_AS_OF)


def q_distinct_lists(spark, sf_dir):
    # Whole table: the list elements as rows (see A.distinct_values).
    return A.distinct_values(_d(spark, sf_dir))


def q_ingest_stats(spark, sf_dir):
    return A.ingest_stats(_r(spark, sf_dir))


def q_payload_size(spark, sf_dir):
    return A.payload_size(_r(spark, sf_dir), DIGITS)


# -- validation ------------------------------------------------------------------

def q_validated_readings(spark, sf_dir):
    return Q.validated_readings(_r(spark, sf_dir, **SCALAR))


def q_validated_bp(spark, sf_dir):
    return Q.validated_bp(_r(spark, sf_dir, **BP))


def q_validation_detail(spark, sf_dir):
    return Q.validation_detail(_r(spark, sf_dir))


def q_range_lookup(spark, sf_dir):
    return Q.range_lookup(_r(spark, sf_dir))


def q_normal_status(spark, sf_dir):
    return Q.normal_status(_r(spark, sf_dir))


def q_quality_report(spark, sf_dir):
    rep = Q.quality_report(_r(spark, sf_dir))
    return rep.select("total_records", F.array_join("issues", "; ").alias("issues"))


def q_alerts(spark, sf_dir):
    return Q.alerts(_r(spark, sf_dir, sensors=("pulse", "temperature", "spo2")))


def q_alerts_bp(spark, sf_dir):
    return Q.alerts_bp(_r(spark, sf_dir, **BP))


def q_union_wide(spark, sf_dir):
    return Q.validated_union(_r(spark, sf_dir))


# -- cleaning --------------------------------------------------------------------

def q_clean_strict(spark, sf_dir):
    return C.clean(_d(spark, sf_dir), mode="strict")


def q_clean_required(spark, sf_dir):
    return C.clean(_d(spark, sf_dir), mode="required")


def q_distinct_rows(spark, sf_dir):
    return C.distinct_rows(_d(spark, sf_dir))


def q_clean_then_sql(spark, sf_dir):
    return run_analysis(spark, _d(spark, sf_dir), digits=DIGITS)["sensor_stats_sql"]


# -- ordering / dashboard ---------------------------------------------------------

def q_recent_20(spark, sf_dir):
    return O.recent(_r(spark, sf_dir), 20)


def q_last_20(spark, sf_dir):
    return O.last_rows(_r(spark, sf_dir), 20)


def q_sensor_series(spark, sf_dir):
    return O.sensor_series(_r(spark, sf_dir, sensors=("pulse",)), "pulse")


# -- windows -----------------------------------------------------------------------

def q_tumbling(spark, sf_dir):
    return W.tumbling(_r(spark, sf_dir, **SCALAR), DAY, digits=DIGITS)


def q_tumbling_bp(spark, sf_dir):
    return W.tumbling_bp(_r(spark, sf_dir, **BP), DAY, digits=DIGITS)


def q_trailing(spark, sf_dir):
    return W.trailing(_r(spark, sf_dir, **SCALAR), TRAILING_US, digits=DIGITS)


def q_trailing_dirty(spark, sf_dir):
    """W3 over rows with NULL keys and values, and copies."""
    return W.trailing(_d(spark, sf_dir), TRAILING_US, digits=DIGITS)


def q_trailing_current_dirty(spark, sf_dir):
    return W.trailing_current(_d(spark, sf_dir), TRAILING_US, digits=DIGITS)


def q_trailing_current(spark, sf_dir):
    return W.trailing_current(_r(spark, sf_dir, **SCALAR), TRAILING_US, digits=DIGITS)


def q_global_trailing(spark, sf_dir):
    return W.flatten_snapshot(W.global_trailing(_r(spark, sf_dir), GLOBAL_US, digits=DIGITS))


def q_window_rows(spark, sf_dir):
    return W.window_rows(_r(spark, sf_dir), GLOBAL_US)


def q_window_current(spark, sf_dir):
    return W.flatten_snapshot(W.window_current(_r(spark, sf_dir), GLOBAL_US, digits=DIGITS))


def q_retention_24h(spark, sf_dir):
    return retain(_r(spark, sf_dir), 24)


# -- projections / transport ---------------------------------------------------------

def q_transport_rows(spark, sf_dir):
    return _r(spark, sf_dir).select("patient_id", "sensor_type", "value", ts_to_epoch("ts").alias("timestamp"))


def q_message_roundtrip(spark, sf_dir):
    transport = q_transport_rows(spark, sf_dir)
    return decode_messages(encode_messages(transport), TRANSPORT_SCHEMA)


def q_composite_key(spark, sf_dir):
    r = _r(spark, sf_dir)
    key = composite_key()
    patient, sensor = split_key(key)
    return r.select("event_id", key.alias("key"), patient.alias("patient_part"), sensor.alias("sensor_part"))


# -- shards / throughput --------------------------------------------------------------

def q_shard_assignment(spark, sf_dir):
    return X.shard_counts(_r(spark, sf_dir), SHARDS)


def q_shard_throughput(spark, sf_dir):
    return X.shard_throughput(_r(spark, sf_dir), SHARDS, DAY)


def q_output_counts(spark, sf_dir):
    r = _r(spark, sf_dir)
    aggs = W.tumbling(r, DAY).select("timestamp").unionByName(W.tumbling_bp(r, DAY).select("timestamp"))
    raw = r.filter(F.col("sensor_type").isNotNull())
    return A.output_counts(raw, aggs, DAY)


# -- streams (drained with availableNow into the shared folder) ----------------------------

def q_stream_tumbling(spark, sf_dir):
    return S.run_to_table(S.tumbling_stream(S.readings_stream(spark, sf_dir), DAY, STREAM_DELAY, DIGITS), "tumbling")


def q_stream_tumbling_bp(spark, sf_dir):
    return S.run_to_table(S.tumbling_bp_stream(S.readings_stream(spark, sf_dir), DAY, STREAM_DELAY, DIGITS), "tumbling-bp")


WINDOW_KEYS = ["patient_id", "sensor_type", "window_start"]


def q_stream_tumbling_update(spark, sf_dir):
    """W1 in update mode: every window, the last ones included."""
    return S.updated(S.tumbling_stream(S.readings_stream(spark, sf_dir), DAY, STREAM_DELAY, DIGITS), "tumbling-update", WINDOW_KEYS)


def q_stream_snapshot(spark, sf_dir):
    snap = S.snapshot_stream(S.readings_stream(spark, sf_dir), "30 minutes", "30 minutes", STREAM_DELAY, DIGITS)
    return W.flatten_snapshot(S.updated(snap, "snapshot", ["window_start"]))


def _reference_json(spark, sf_dir):
    """Readings written as four-field JSON records with epoch seconds (and the parts of blood pressure)."""
    path = scratch_path(spark, "reference-jsonl")
    r = _r(spark, sf_dir)
    r.select("patient_id", "sensor_type", "value", "systolic", "diastolic", ts_to_epoch_float("ts").alias("timestamp")).write.json(path)
    return path


def q_jsonl_reference(spark, sf_dir):
    """Reference-shaped records read, cleaned and grouped."""
    return A.by_sensor(C.clean(read_jsonl(spark, _reference_json(spark, sf_dir))), DIGITS)


def q_message_tumbling(spark, sf_dir):
    """Messages of that shape through the stream's windows."""
    messages = S.message_stream(spark, _reference_json(spark, sf_dir))
    return S.updated(S.tumbling_stream(messages, DAY, STREAM_DELAY, DIGITS), "message-tumbling", WINDOW_KEYS)


def q_message_arrival(spark, sf_dir):
    """P5: messages and how many have an arrival time."""
    got = S.run_to_table(S.message_stream(spark, _reference_json(spark, sf_dir)), "arrival")
    return got.agg(F.count(F.lit(1)).alias("messages"), F.count("_received_at").alias("stamped"))


def q_stream_dedup(spark, sf_dir):
    r = S.readings_stream(spark, sf_dir)
    doubled = r.unionByName(r.filter(F.col("event_id") % 10 == 0))
    return S.run_to_table(S.dedup_stream(doubled, STREAM_DELAY), "dedup")


def q_stream_trailing_exact(spark, sf_dir):
    exact = trailing_stream_exact(S.readings_stream(spark, sf_dir), TRAILING_US, STREAM_DELAY, DIGITS)
    return S.run_to_table(exact, "trailing-exact")


def q_stream_trailing_dirty(spark, sf_dir):
    """W8 over rows with NULL keys and values, and copies."""
    dirty = dirty_readings_from(S.readings_stream(spark, sf_dir))
    return S.run_to_table(trailing_stream_exact(dirty, TRAILING_US, STREAM_DELAY, DIGITS), "trailing-dirty")


def q_stream_global_trailing(spark, sf_dir):
    """W5 on a stream: the snapshot at every instant of closed time."""
    snapshots = global_trailing_stream(S.readings_stream(spark, sf_dir), GLOBAL_US, STREAM_DELAY, DIGITS)
    return W.flatten_snapshot(S.run_to_table(snapshots, "global-trailing", long_lists=True))


def q_stream_kpis(spark, sf_dir):
    """A9 on a stream: exact counts per day."""
    return S.run_to_table(S.kpis_stream(S.readings_stream(spark, sf_dir), DAY, STREAM_DELAY), "kpis")


def q_state_current(spark, sf_dir):
    """W4 answered from the state of a stream, by the reader of state stores."""
    base = scratch_path(spark, "stream-current")
    S.run_to_table(trailing_stream_exact(S.readings_stream(spark, sf_dir), TRAILING_US, STREAM_DELAY, DIGITS, keep_current=True), "current", base=base)
    return current_from_state(spark, f"{base}/_checkpoint", TRAILING_US, DIGITS)


def q_stream_progress(spark, sf_dir):
    """What the batches of a stream reported while it ran."""
    parts = scratch_path(spark, "progress-src")
    spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").repartition(4).write.parquet(parts)
    stream = S.readings_stream(spark, parts, glob="*.parquet", max_files_per_trigger=1)
    base = scratch_path(spark, "progress")
    with progress_to(spark, f"{base}/reports") as reports:
        query = S.start_to_parquet(stream, f"{base}/out", f"{base}/_checkpoint")
        query.awaitTermination()
        if not reports.wait(str(query.runId)):
            raise TimeoutError("the stream's last report has not come")
    own = reports.table().filter((F.col("run_id") == str(query.runId)) & (F.col("input_rows") > 0))
    return own.agg(F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"))


def q_stream_hop(spark, sf_dir):
    hop = S.hop_stream(S.readings_stream(spark, sf_dir), "6 days", DAY, STREAM_DELAY, DIGITS)
    return S.run_to_table(hop, "hop")


# -- sources / sinks round trips ---------------------------------------------------------

def q_jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    write_jsonl(_r(spark, sf_dir), path)
    return read_jsonl(spark, path, READING_JSON_SCHEMA).select(*READING_COLUMNS)


def q_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    write_parquet(_r(spark, sf_dir), path, partition_by=["sensor_type"])
    return read_parquet(spark, path, _r(spark, sf_dir).schema).select(*READING_COLUMNS)


def q_named_dataset(spark, sf_dir):
    ticket = f"vitalis_ds_{uuid.uuid4().hex[:12]}"
    catalog.put(_r(spark, sf_dir), ticket, {"source": "events"})
    return catalog.get(spark, ticket).select(*READING_COLUMNS)


def q_jsonl_or_empty(spark, sf_dir):
    """A file that exists, and one that doesn't (no rows)."""
    path = scratch_path(spark, "jsonl")
    write_jsonl(_r(spark, sf_dir), path)
    both = read_jsonl_or_empty(spark, path).unionByName(read_jsonl_or_empty(spark, f"{path}-missing"))
    return both.select(*READING_COLUMNS)


def q_source_preference(spark, sf_dir):
    """JSON lines when there is no Parquet, then Parquet."""
    path = scratch_path(spark, "preferred")
    write_jsonl(_r(spark, sf_dir), f"{path}-json")
    write_parquet(load_preferred(spark, path, f"{path}-json"), path)
    return load_preferred(spark, path, f"{path}-json").select(*READING_COLUMNS)


def q_record_batches(spark, sf_dir):
    path = scratch_path(spark, "batches")
    return read_parquet(spark, write_batched(_r(spark, sf_dir), path, 1000)).select(*READING_COLUMNS)


def q_arrow_hand_off(spark, sf_dir):
    return read_parquet(spark, hand_off(_r(spark, sf_dir), scratch_path(spark, "arrow"))).select(*READING_COLUMNS)


def q_corrupt_split(spark, sf_dir):
    """Every 13th message is cut off after ten characters; good and bad lines are counted."""
    path = scratch_path(spark, "corrupt")
    lines = encode_messages(_r(spark, sf_dir).select("event_id", "patient_id", "sensor_type", "value"))
    event = F.get_json_object("value", "$.event_id").cast("long")
    lines.select(F.when(event % 13 == 0, F.substring("value", 1, 10)).otherwise(F.col("value"))).write.text(path)
    good, bad = split_corrupt(read_jsonl(spark, path, mode="PERMISSIVE"))
    return good.select(F.lit("good").alias("kind")).union(bad.select(F.lit("bad"))).groupBy("kind").agg(F.count(F.lit(1)).alias("count"))


def q_corrupt_rows(spark, sf_dir):
    """The good rows and the raw bad lines themselves."""
    path = scratch_path(spark, "corrupt")
    lines = encode_messages(_r(spark, sf_dir).select("event_id", "patient_id", "sensor_type", "value"))
    event = F.get_json_object("value", "$.event_id").cast("long")
    lines.select(F.when(event % 13 == 0, F.concat(F.lit("{cut "), event.cast("string"))).otherwise(F.col("value"))).write.text(path)
    good, bad = split_corrupt(read_jsonl(spark, path, MESSAGE, mode="PERMISSIVE"))
    fields = ("event_id", "patient_id", "sensor_type", "value")
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in fields])
    return good.select(F.lit("good").alias("kind"), text.alias("line")).union(bad.select(F.lit("bad").alias("kind"), F.col(CORRUPT_COLUMN).alias("line")))


def q_dataset_tickets(spark, sf_dir):
    """Tickets that differ in case or in odd characters only are different data sets."""
    run = uuid.uuid4().hex[:12]
    tickets = {"pulse": f"{run} Run-1", "temperature": f"{run} run-1", "spo2": f"{run} run_x2d_1", "blood_pressure": f"{run} r/ü 1"}
    for sensor, ticket in tickets.items():
        catalog.put(_r(spark, sf_dir, sensors=(sensor,)), ticket)
    catalog.put(_r(spark, sf_dir, sensors=("pulse",)), tickets["pulse"])  # a second put appends
    listed = catalog.list_datasets(spark).filter(F.startswith("ticket", F.lit(run)))
    got = None
    for ticket in tickets.values():
        one = catalog.get(spark, ticket).groupBy("sensor_type").agg(F.count(F.lit(1)).alias("rows")).withColumn("ticket", F.lit(ticket))
        got = one if got is None else got.unionByName(one)
    return got.join(listed, "ticket").select("sensor_type", "rows", "records", F.substring("ticket", 14, 9).alias("ticket"))


def q_retention_sink(spark, sf_dir):
    """Date folders written, the expired ones removed, what the store still holds."""
    path = scratch_path(spark, "retained")
    r = _r(spark, sf_dir)
    write_retained(r, path)
    expire(spark, path, 24)
    return spark.read.schema(r.schema).parquet(path).select(*READING_COLUMNS)


def q_analysis_observed(spark, sf_dir):
    """V9, D3 and S7 in one pass."""
    report = run_observed(spark, _d(spark, sf_dir))["report"]
    return report.select("total_records", F.array_join("issues", "; ").alias("issues"), "cleaned_records")


def q_dedup_history(spark, sf_dir):
    """D1 across all history: copies that come in other batches are found in a bucketed table of keys."""
    path = scratch_path(spark, "history")
    C.drop_missing_required(_d(spark, sf_dir)).withColumn("_part", F.floor(F.rand(7) * 4).cast("int")).write.partitionBy("_part").parquet(f"{path}/in")
    history = History(spark, f"vitalis_history_{uuid.uuid4().hex[:12]}", path, buckets=8)
    incoming = spark.read.schema(_d(spark, sf_dir).schema.add("_part", T.IntegerType())).parquet(f"{path}/in")
    for part in range(4):
        history.add(incoming.filter(F.col("_part") == part).drop("_part"), part)
    return history.rows().select(*READING_COLUMNS)


def q_rounded_values(spark, sf_dir):
    """Values rounded half up to one decimal."""
    return _r(spark, sf_dir, **SCALAR).select("event_id", round_to("value", 1).alias("value"))


def q_jsonl_blank_lines(spark, sf_dir):
    """F8: blank lines and lines of spaces between the records are no records."""
    path = scratch_path(spark, "blank-lines")
    lines = encode_messages(_r(spark, sf_dir).select("event_id", "patient_id", "sensor_type", "value"))
    lines.select(F.explode(F.array(F.lit(""), F.col("value"), F.lit("   "))).alias("value")).write.text(path)
    return read_jsonl(spark, path, MESSAGE).select("event_id", "patient_id", "sensor_type", "value")


def q_tagged_lines(spark, sf_dir):
    """The tagged lines read back, every field of them."""
    r = _r(spark, sf_dir)
    path = scratch_path(spark, "tagged")
    tagged_output(Q.validated_readings(W.scalar_readings(r)), W.tumbling(r, DAY, digits=DIGITS)).select("line").write.text(path)
    fields = "patient_id string, sensor_type string, value double, is_valid string, count double, avg double, min double, max double"
    json = F.from_json(F.substring("value", 7, 1 << 20), fields)
    return spark.read.text(path).select(F.substring("value", 2, 3).alias("kind"), json.alias("j")).select("kind", "j.*")


def q_batch_files(spark, sf_dir):
    """How many rows the files hold, and whether none has more than a batch."""
    path = write_batched(_r(spark, sf_dir), scratch_path(spark, "batches"), 1000)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("rows"), (F.max("n") <= 1000).alias("within"), (F.count(F.lit(1)) >= F.ceil(F.sum("n") / 1000)).alias("enough_files"))


def q_dataset_list(spark, sf_dir):
    ticket = f"vitalis-ds-{uuid.uuid4().hex[:12]}"
    catalog.put(_r(spark, sf_dir), ticket, {"note": "the events' readings"})
    listed = catalog.list_datasets(spark).filter(F.col("ticket") == ticket)
    return listed.select("records", (F.col("total_bytes") > 0).alias("has_bytes"))


def q_report_file(spark, sf_dir):
    path = scratch_path(spark, "report")
    report = A.by_sensor(_r(spark, sf_dir), DIGITS)
    return spark.read.schema(report.schema).json(write_report(report, path))


def q_tagged_output(spark, sf_dir):
    r = _r(spark, sf_dir)
    lines = tagged_output(Q.validated_readings(W.scalar_readings(r)), W.tumbling(r, DAY))
    return lines.groupBy("kind", F.substring("line", 1, 7).alias("start")).agg(F.count(F.lit(1)).alias("count"))


def q_record_texts(spark, sf_dir):
    """Epoch seconds to time and its ISO text; a default for a missing part."""
    r = _r(spark, sf_dir)
    return r.select("event_id", iso_text(epoch_to_ts(ts_to_epoch("ts"))).alias("iso"), with_default("systolic", 0.0).alias("systolic"))


#: Queries whose result SQL can't state; tests hold them against brute force.
NO_SQL: set[str] = set()

QUERIES: dict[str, Query] = {
    "stream_trailing_dirty": q_stream_trailing_dirty,
    "stream_global_trailing": q_stream_global_trailing,
    "stream_kpis": q_stream_kpis,
    "state_current": q_state_current,
    "stream_progress": q_stream_progress,
    "corrupt_rows": q_corrupt_rows,
    "dataset_tickets": q_dataset_tickets,
    "retention_sink": q_retention_sink,
    "analysis_observed": q_analysis_observed,
    "dedup_history": q_dedup_history,
    "rounded_values": q_rounded_values,
    "jsonl_blank_lines": q_jsonl_blank_lines,
    "tagged_lines": q_tagged_lines,
    "batch_files": q_batch_files,
    "jsonl_reference": q_jsonl_reference,
    "jsonl_or_empty": q_jsonl_or_empty,
    "source_preference": q_source_preference,
    "record_batches": q_record_batches,
    "arrow_hand_off": q_arrow_hand_off,
    "corrupt_split": q_corrupt_split,
    "dataset_list": q_dataset_list,
    "report_file": q_report_file,
    "tagged_output": q_tagged_output,
    "record_texts": q_record_texts,
    "message_tumbling": q_message_tumbling,
    "message_arrival": q_message_arrival,
    "stream_tumbling_update": q_stream_tumbling_update,
    "stream_snapshot": q_stream_snapshot,
    "trailing_dirty": q_trailing_dirty,
    "trailing_current_dirty": q_trailing_current_dirty,
    "sensor_stats_sql": q_sensor_stats_sql,
    "patient_stats_sql": q_patient_stats_sql,
    "sql_on_parquet": q_sql_on_parquet,
    "sql_validate": q_sql_validate,
    "sensor_stats": q_sensor_stats,
    "patient_stats": q_patient_stats,
    "patient_summary": q_patient_summary,
    "pulse_stats": q_pulse_stats,
    "patient_counts": q_patient_counts,
    "sensor_count_avg": q_sensor_count_avg,
    "value_stats": q_value_stats,
    "validated_readings": q_validated_readings,
    "validated_bp": q_validated_bp,
    "validation_detail": q_validation_detail,
    "range_lookup": q_range_lookup,
    "normal_status": q_normal_status,
    "quality_report": q_quality_report,
    "alerts": q_alerts,
    "alerts_bp": q_alerts_bp,
    "clean_strict": q_clean_strict,
    "clean_required": q_clean_required,
    "distinct_rows": q_distinct_rows,
    "clean_then_sql": q_clean_then_sql,
    "union_wide": q_union_wide,
    "sensor_distribution": q_sensor_distribution,
    "per_clock_minute": q_per_clock_minute,
    "per_minute": q_per_minute,
    "histogram": q_histogram,
    "kpis": q_kpis,
    "distinct_lists": q_distinct_lists,
    "recent_20": q_recent_20,
    "last_20": q_last_20,
    "sensor_series": q_sensor_series,
    "tumbling": q_tumbling,
    "tumbling_bp": q_tumbling_bp,
    "trailing": q_trailing,
    "trailing_current": q_trailing_current,
    "global_trailing": q_global_trailing,
    "window_rows": q_window_rows,
    "window_current": q_window_current,
    "retention_24h": q_retention_24h,
    "transport_rows": q_transport_rows,
    "message_roundtrip": q_message_roundtrip,
    "composite_key": q_composite_key,
    "payload_size": q_payload_size,
    "shard_assignment": q_shard_assignment,
    "shard_throughput": q_shard_throughput,
    "output_counts": q_output_counts,
    "ingest_stats": q_ingest_stats,
    "stream_tumbling": q_stream_tumbling,
    "stream_tumbling_bp": q_stream_tumbling_bp,
    "stream_dedup": q_stream_dedup,
    "stream_hop": q_stream_hop,
    "stream_trailing_exact": q_stream_trailing_exact,
    "jsonl_roundtrip": q_jsonl_roundtrip,
    "parquet_roundtrip": q_parquet_roundtrip,
    "named_dataset": q_named_dataset,
}
