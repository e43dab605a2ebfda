"""Structured Streaming forms of the collector and consumer (S10, R1-R8, W8,
stream forms of W1, W2, D1).

Event time throughout, with a watermark bounding state: a window is emitted
(append mode) once the watermark passes its end, and its state is dropped.
Sources are file directories here; a Kafka source plugs into the same
``from_json`` / projection step.  Checkpoints live under the shared folder
(``spark.checkpoint.dir``).  A function that is given ``base`` keeps its output
and checkpoint there, so a query that is started again with the same ``base``
resumes where it stopped; without it every call starts afresh.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from vitalis.functions.stats import avg_col
from vitalis.operators.clean import DEDUP_KEY
from vitalis.operators.windows import _snapshot_finish, _snapshot_parts, bp_readings, scalar_readings, tumbling, tumbling_bp
from vitalis.schema import EVENTS_SCHEMA, READING_JSON_SCHEMA
from vitalis.session import prepare, scratch_path
from vitalis.sources.files import CORRUPT_COLUMN, canonical
from vitalis.sources.readings import readings_from_events
from vitalis.streaming.state import use_rocksdb_state  # noqa: F401  R3


#: Files that a micro-batch reads, at most, unless the caller says otherwise.
FILES_PER_TRIGGER = 64


def events_stream(
    spark: SparkSession, source_dir: str, glob: str | None = None, max_files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """Driver events as a file stream (files picked up in modification order).

    Reads the table ``events.parquet`` of the folder, be it one file or a folder of part files;
    with ``glob``, the files of the folder itself that match.
    """
    prepare(spark)
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        return reader.option("pathGlobFilter", glob).parquet(source_dir)
    return reader.parquet(f"{source_dir.rstrip('/')}/events.parque[t]")  # a pattern: a path itself may not be a file


def readings_stream(spark: SparkSession, source_dir: str, **kw) -> DataFrame:
    """Wide readings stream; ``ts`` is TIMESTAMP (watermarks need it)."""
    return readings_from_events(events_stream(spark, source_dir, **kw), instant=True)


def message_stream(spark: SparkSession, source_dir: str, schema: T.StructType = READING_JSON_SCHEMA, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """S10 + P5 + P12: JSON messages from a directory; bad lines are kept in
    ``_corrupt_record`` (T20) and every row is stamped with its arrival time."""
    prepare(spark)
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    raw = (
        spark.readStream.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(source_dir)
    )
    return canonical(raw).withColumn("_received_at", F.current_timestamp()).withColumn(
        "_received_timestamp", F.unix_micros(F.col("_received_at")) / F.lit(1e6)
    )


def tumbling_stream(readings: DataFrame, size: str = "5 seconds", delay: str = "10 seconds", digits: int | None = None) -> DataFrame:
    """W1 on a stream: the batch operator behind a watermark.

    The watermark follows the rows this aggregate sees (scalar readings);
    Catalyst would push the sensor filter below the watermark anyway, so it
    is stated explicitly here.
    """
    return tumbling(scalar_readings(readings).withWatermark("ts", delay), size=size, digits=digits)


def tumbling_bp_stream(
    readings: DataFrame, size: str = "5 seconds", delay: str = "10 seconds", digits: int | None = None
) -> DataFrame:
    """W2 on a stream; the watermark follows the blood-pressure rows."""
    return tumbling_bp(bp_readings(readings).withWatermark("ts", delay), size=size, digits=digits)


def dedup_stream(readings: DataFrame, delay: str = "10 seconds", key: list[str] | None = None) -> DataFrame:
    """Duplicates within the watermark delay removed; state is evicted as
    the watermark moves, so it stays bounded."""
    return readings.withWatermark("ts", delay).dropDuplicatesWithinWatermark(key or DEDUP_KEY)


def hop_stream(
    readings: DataFrame,
    size: str = "30 seconds",
    slide: str = "5 seconds",
    delay: str = "10 seconds",
    digits: int | None = None,
) -> DataFrame:
    """Streaming stand-in for the trailing window, as hopping windows.

    Spark rejects analytic range frames on streams; hop windows of length W
    sliding by s give the trailing stats at every slide boundary.
    """
    data = scalar_readings(readings).withWatermark("ts", delay)
    g = data.groupBy(F.window("ts", size, slide).alias("w"), "patient_id", "sensor_type").agg(
        F.count(F.lit(1)).alias("count"),
        avg_col("value", digits).alias("avg"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return g.select(
        "patient_id", "sensor_type", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "count", "avg", "min", "max",
    )


def kpis_stream(readings: DataFrame, size: str = "1 minute", delay: str = "10 seconds") -> DataFrame:
    """A9 on a stream, per tumbling window: readings, patients, sensor types, newest time.

    Streams reject ``count(distinct)``, so three aggregates run one behind the other in one append
    query: per (window, patient, sensor), per (window, patient), and per window, where the rows of the second are the
    distinct patients.  All counts are exact, and a window that holds a third of all
    rows is reduced per patient before it meets in one row."""
    w = F.window("ts", size)
    each = readings.withWatermark("ts", delay).groupBy(w.alias("w"), F.coalesce("patient_id", F.lit("unknown")).alias("p"), F.coalesce("sensor_type", F.lit("unknown")).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest"))
    people = each.groupBy(F.window(F.window_time("w"), size).alias("w"), "p").agg(F.sum("n").alias("n"), F.collect_set("s").alias("s"), F.max("latest").alias("latest"))
    g = people.groupBy(F.window(F.window_time("w"), size).alias("w")).agg(
        F.sum("n").alias("total_readings"),
        F.count(F.lit(1)).alias("patients"),
        F.size(F.array_distinct(F.flatten(F.collect_set("s")))).alias("sensor_types"),
        F.max("latest").alias("latest"),
    )
    return g.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "total_readings", "patients", "sensor_types", "latest",
    )


#: Files of rows with long lists that hardly differ from row to row (with zstd): it finds the list before in plain pages, but not in
#: numbers of a dictionary, and a reader takes a row group or 4096 rows at once, whichever is less.
LONG_LISTS = {"parquet.enable.dictionary": "false", "parquet.block.size": str(1 << 20)}


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session that a sink is made under."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_to_parquet(
    df: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "append",
    available_now: bool = True,
    processing_time: str = "5 seconds",
    long_lists: bool = False,
) -> StreamingQuery:
    """Start a stream into a Parquet sink.  ``available_now`` drains what is
    there and stops (tests, backfills); otherwise a 5 s processing-time
    trigger (R1).  ``long_lists``: files for rows with long lists that hardly differ from row to row."""
    w = df.writeStream.format("parquet").outputMode(output_mode).option("checkpointLocation", checkpoint)
    if long_lists:
        with _settings(df.sparkSession, LONG_LISTS):  # a sink takes them when it is made
            return _triggered(w.option("compression", "zstd"), available_now, processing_time).start(path)
    return _triggered(w, available_now, processing_time).start(path)


def _triggered(w: DataStreamWriter, available_now: bool, processing_time: str) -> DataStreamWriter:
    return w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)


def run_to_table(df: DataFrame, kind: str, output_mode: str = "append", base: str | None = None, long_lists: bool = False) -> DataFrame:
    """Drain a stream into ``base`` (default: a fresh folder of the shared folder) and return the
    result as a batch DataFrame (the sink's own file log decides what is
    committed, so a retried batch is not counted twice)."""
    spark = df.sparkSession
    base = base or scratch_path(spark, f"stream-{kind}")
    path, checkpoint = f"{base}/out", f"{base}/_checkpoint"
    q = start_to_parquet(df, path, checkpoint, output_mode, long_lists=long_lists)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(df.schema).parquet(path)


def upsert_log_stream(df: DataFrame, kind: str = "upserts", base: str | None = None, processing_time: str | None = None) -> tuple[str, StreamingQuery]:
    """R6 (update mode): each micro-batch's changed rows go to their own
    ``batch_id=N`` folder.  A retried batch overwrites its folder, so the log
    is idempotent; ``read_latest`` folds it to the newest version per key.
    Returns the log path and the started query (drained with availableNow, or running with a
    ``processing_time`` trigger)."""
    spark = df.sparkSession
    base = base or scratch_path(spark, f"upsert-{kind}")
    path = f"{base}/log"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    q = (
        df.writeStream.outputMode("update")
        .option("checkpointLocation", f"{base}/_checkpoint")
        .foreachBatch(write_batch)
        .trigger(**_trigger(processing_time))
        .start()
    )
    return path, q


def _trigger(processing_time: str | None) -> dict:
    return {"processingTime": processing_time} if processing_time else {"availableNow": True}


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest version of every key in an upsert log: ``max_by`` over the batch
    id, a partial + final aggregate (no sort, no single partition)."""
    log = spark.read.parquet(path)
    values = [c for c in log.columns if c not in keys and c != "batch_id"]
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def updated(df: DataFrame, kind: str, keys: list[str], base: str | None = None) -> DataFrame:
    """Drain an aggregating stream in update mode and return the newest version of every key: all windows,
    those that the watermark hasn't closed included (the flush of the last window)."""
    path, query = upsert_log_stream(df, kind, base)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return read_latest(df.sparkSession, path, keys).select(*df.columns)


def snapshot_stream(readings: DataFrame, size: str = "30 seconds", slide: str = "5 seconds", delay: str = "10 seconds", digits: int | None = None) -> DataFrame:
    """W5 / W7 on a stream: the consumer's snapshot (count, duration, lists, per-sensor structs) of each
    hopping window of length W."""
    g = readings.withWatermark("ts", delay).withColumn("_us", F.unix_micros("ts")).groupBy(F.window("ts", size, slide).alias("w"))
    duration = (F.max("_us") - F.min("_us")) / F.lit(1e6)
    parts = g.agg(duration.alias("window_duration"), *_snapshot_parts(None, digits))
    return parts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "window_duration", *_snapshot_finish(digits))


def publish_stream(df: DataFrame, kind: str = "messages", base: str | None = None, processing_time: str | None = None) -> StreamingQuery:
    """S11 + S20 on a stream: every row as a JSON message into a text sink
    under the shared folder (a Kafka sink takes the same ``value`` column)."""
    base = base or scratch_path(df.sparkSession, f"publish-{kind}")
    msgs = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
    return (
        msgs.writeStream.format("text")
        .option("checkpointLocation", f"{base}/_checkpoint")
        .trigger(**_trigger(processing_time))
        .start(f"{base}/out")
    )


def tagged_streams(raw: DataFrame, aggregates: DataFrame, kind: str = "output", base: str | None = None, processing_time: str | None = None) -> tuple[str, list[StreamingQuery]]:
    """S20 on streams: raw rows and aggregates as two queries into the
    ``kind=raw`` / ``kind=agg`` folders of one table, so a reader sees a
    single output with a ``kind`` column.  Returns the table path and the
    started queries (drained with availableNow)."""
    base = base or scratch_path(raw.sparkSession, f"tagged-{kind}")
    queries = []
    for label, df in (("raw", raw), ("agg", aggregates)):
        line = F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("line")
        queries.append(
            df.select(line)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{base}/_checkpoint_{label}")
            .trigger(**_trigger(processing_time))
            .start(f"{base}/out/kind={label}")
        )
    return f"{base}/out", queries


def progress_summary(query: StreamingQuery) -> dict:
    """Rows and rates of the last micro-batch, plus rows dropped as late."""
    p = query.lastProgress or {}
    late = sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", []))
    return {
        "batch_id": p.get("batchId"),
        "input_rows": p.get("numInputRows", 0),
        "input_rows_per_second": p.get("inputRowsPerSecond", 0.0),
        "processed_rows_per_second": p.get("processedRowsPerSecond", 0.0),
        "rows_dropped_by_watermark": late,
        "watermark": (p.get("eventTime") or {}).get("watermark"),
    }
