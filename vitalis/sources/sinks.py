"""File sinks, message encoding and hand-offs.

Writes are distributed (one file set per task); nothing goes through the
driver except bounded results handed to Arrow on purpose.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.schema import JSON_TIMESTAMP_FORMAT
from vitalis.sources import store


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Parquet sink; ``partition_by=['sensor_type']`` enables partition pruning later."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", epoch_column: str | None = "timestamp") -> str:
    """JSON-lines sink.  Timestamps are written as ISO text (exact to the
    microsecond); ``epoch_column`` adds the epoch-seconds float the reference
    records carry."""
    out = df
    if epoch_column and "ts" in df.columns and epoch_column not in df.columns:
        out = out.withColumn(epoch_column, F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6))
    for f in out.schema.fields:
        if f.dataType.typeName() == "timestamp_ntz":
            out = out.withColumn(f.name, F.col(f.name).cast("timestamp"))
    out.write.mode(mode).option("timestampFormat", JSON_TIMESTAMP_FORMAT).json(path)
    return path


#: Rows of a report, at most: one task writes them.
REPORT_ROWS = 100_000


def write_report(df: DataFrame, path: str, most: int = REPORT_ROWS) -> str:
    """A (small) report DataFrame as JSON, one file (what it is computed from stays parallel).

    A result of more than ``most`` rows is no report: ``ValueError``, and nothing stays written.
    """
    df.limit(most + 1).repartition(1).write.mode("overwrite").json(path)
    if df.sparkSession.read.text(path).count() > most:
        store.delete(df.sparkSession, path)
        raise ValueError(f"more than {most} rows are no report; write them as a table")
    return path


def write_batched(df: DataFrame, path: str, batch_size: int, fmt: str = "parquet") -> str:
    """Fixed-size record batches, as files of at most ``batch_size`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", batch_size).format(fmt).save(path)
    return path


def encode_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON message per row, in the ``key``/``value`` shape
    that file and Kafka sinks accept."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")]
    if key:
        cols.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def decode_messages(messages: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON message text back to columns."""
    return messages.select(F.from_json(F.col(column), schema).alias("_m")).select("_m.*")


def tagged_output(raw: DataFrame, aggregates: DataFrame) -> DataFrame:
    """One output of tagged lines, ``[RAW] {...}`` and ``[AGG] {...}``."""
    def tag(df: DataFrame, label: str) -> DataFrame:
        return df.select(
            F.lit(label).alias("kind"),
            F.concat(F.lit(f"[{label}] "), F.to_json(F.struct(*[F.col(c) for c in df.columns]))).alias("line"),
        )

    return tag(raw, "RAW").unionByName(tag(aggregates, "AGG"))


def hand_off(df: DataFrame, path: str) -> str:
    """Hand a result of any size to an Arrow reader: Parquet files written by the executors.
    Returns the folder, which ``pyarrow.dataset`` (or any Arrow reader) opens as one table."""
    df.write.mode("overwrite").parquet(path)
    return path


def report_to_arrow(report: DataFrame):
    """S16 for an aggregated report (rows as many as sensors or windows, not as readings): an Arrow
    table in the driver, within Spark's own ``spark.driver.maxResultSize``."""
    return report.toArrow()


def publish(df: DataFrame, path: str, mode: str = "append") -> str:
    """Publish rows as JSON messages to one topic, here a directory of
    text files (a Kafka sink takes the same ``value`` column)."""
    encode_messages(df).write.mode(mode).text(path)
    return path


def write_retained(df: DataFrame, path: str, ts: str = "ts", mode: str = "append") -> str:
    """S12 sink side: date-partitioned directories, so retention is dropping
    whole ``date=...`` folders and readers prune by date."""
    df.withColumn("date", F.to_date(F.col(ts))).write.mode(mode).partitionBy("date").parquet(path)
    return path


def expire(spark: SparkSession, path: str, hours: int = 24, as_of: datetime | None = None) -> list[str]:
    """Remove the ``date=`` folders of a retained store whose rows are all older than ``hours``.

    Only folder names are read.  ``as_of``: the time to count from; by default the start of the newest
    day that has a folder, so that no row within ``hours`` of the newest one can go.  Folders
    that hold a younger time stay whole (:func:`retain` trims them on reading).  A running append is
    safe: it writes to hidden folders until it commits, and a day that is expired takes no rows within the
    limit.  Returns the names of the removed folders; a second call removes nothing.
    """
    days = {}
    for name in store.names(spark, path):
        if name.startswith("date="):
            try:
                days[name] = datetime.strptime(name[5:], "%Y-%m-%d")
            except ValueError:
                continue  # rows without a time (date=__HIVE_DEFAULT_PARTITION__) have no age
    if not days:
        return []
    limit = (as_of or max(days.values())) - timedelta(hours=hours)
    gone = [n for n, day in days.items() if day + timedelta(days=1) <= limit]
    for name in gone:
        store.delete(spark, f"{path.rstrip('/')}/{name}")
    return gone


def retain(df: DataFrame, hours: int = 24, ts: str = "ts") -> DataFrame:
    """S12 batch side: rows newer than ``newest - hours``.  The newest time is
    one scalar, so the bound is a literal filter pushed into the scan."""
    newest = df.agg(F.max(ts)).first()[0]
    if newest is None:
        return df.limit(0)
    return df.filter(F.col(ts) > F.lit(newest) - F.expr(f"INTERVAL {int(hours)} HOURS"))
