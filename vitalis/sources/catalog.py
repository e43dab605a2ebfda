"""Named data sets (S13-S15): the ticketed byte store re-aimed at committed folders.

A data set lives under the shared folder (``spark.checkpoint.dir``), in a folder
named by a hash of its ticket, so any two tickets are apart.  Every ``put`` writes its rows to
a folder of its own and then publishes one commit record (ticket, rows, bytes, folder, schema,
metadata) by an atomic rename.  Rows without a commit record, as of a put that
failed, belong to nothing.  ``get`` reads the committed folders; ``list_datasets`` sums the commit
records with Spark and opens no data file.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.session import shared_dir
from vitalis.sources import store

_RECORD = "ticket string, put string, records long, bytes long, schema string, metadata map<string,string>, replaces array<string>"


def _root(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), "vitalis", "named")


def _home(spark: SparkSession, ticket: str) -> str:
    return os.path.join(_root(spark), hashlib.sha256(ticket.encode()).hexdigest())


def _commits(spark: SparkSession, ticket: str) -> list:
    """Commit records of a ticket, one per put."""
    home = _home(spark, ticket)
    if not any(n.endswith(".json") for n in store.names(spark, f"{home}/commits")):
        return []
    found = spark.read.schema(_RECORD).json(f"{home}/commits").select("*", F.col("_metadata.file_modification_time").alias("at"))
    known = found.filter(F.col("ticket") == ticket).orderBy("at", "put").collect()
    gone = {p for r in known for p in r["replaces"] or []}
    return [r for r in known if r["put"] not in gone]


def put(df: DataFrame, ticket: str, metadata: dict[str, str] | None = None) -> str:
    """Append rows under ``ticket`` (created on first use); all of them or, if the write fails, none.

    A later put must have the columns of the first: ``ValueError`` otherwise.
    """
    spark = df.sparkSession
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    known = _commits(spark, ticket)
    if known and T.StructType.fromJson(json.loads(known[0]["schema"])) != schema:
        raise ValueError(f"data set {ticket!r} has other columns: {known[0]['schema']}")
    _commit(df, ticket, schema, {str(k): str(v) for k, v in (metadata or {}).items()}, [])
    return ticket


def _commit(df: DataFrame, ticket: str, schema: T.StructType, told: dict[str, str], replaces: list[str]) -> None:
    """Write rows to a folder of their own, then the record that makes them count (in place of those that it replaces)."""
    spark = df.sparkSession
    home, name = _home(spark, ticket), uuid.uuid4().hex
    folder = f"{home}/data/{name}"
    df.write.parquet(folder)
    record = {
        "ticket": ticket,
        "put": name,
        "records": spark.read.schema(schema).parquet(folder).count(),  # from the files' footers
        "bytes": store.folder_bytes(spark, folder),
        "schema": schema.json(),
        "metadata": told,
        "replaces": replaces,
    }
    store.publish_text(spark, f"{home}/commits/{name}.json", json.dumps(record) + "\n")


def compact(spark: SparkSession, ticket: str) -> int:
    """Make one put of all puts of a ticket, so that many small ones cost readers no more; returns how many there were.

    Readers see the old puts or the new one, never both: its record names those that it replaces.  Only then are these deleted.
    """
    known = _commits(spark, ticket)
    if not known:
        raise KeyError(f"data set not found: {ticket}")
    if len(known) > 1:
        schema, old = T.StructType.fromJson(json.loads(known[0]["schema"])), [r["put"] for r in known]
        _commit(get(spark, ticket), ticket, schema, metadata(spark, ticket), old)
        for name in old:
            store.delete(spark, f"{_home(spark, ticket)}/commits/{name}.json")
            store.delete(spark, f"{_home(spark, ticket)}/data/{name}")
    return len(known)


def get(spark: SparkSession, ticket: str) -> DataFrame:
    """Rows of ``ticket``; ``KeyError`` when absent."""
    known = _commits(spark, ticket)
    if not known:
        raise KeyError(f"data set not found: {ticket}")
    schema = T.StructType.fromJson(json.loads(known[0]["schema"]))
    return spark.read.schema(schema).parquet(*[f"{_home(spark, ticket)}/data/{r['put']}" for r in known])


def metadata(spark: SparkSession, ticket: str) -> dict[str, str]:
    """What the puts said about the data set; later ones win."""
    out: dict[str, str] = {}
    for r in _commits(spark, ticket):
        out |= r["metadata"] or {}
    return out


def list_datasets(spark: SparkSession) -> DataFrame:
    """The known tickets with their row counts and stored bytes, from the commit records alone."""
    if not any(store.exists(spark, f"{_root(spark)}/{n}/commits") for n in store.names(spark, _root(spark))):
        return spark.createDataFrame([], "ticket string, records bigint, total_bytes bigint")
    found = spark.read.schema(_RECORD).json(f"{_root(spark)}/*/commits")
    gone = found.select(F.explode("replaces").alias("put"))  # of a compaction that hasn't cleared up yet
    return found.join(gone, "put", "left_anti").groupBy("ticket").agg(F.sum("records").alias("records"), F.sum("bytes").alias("total_bytes"))


def drop(spark: SparkSession, ticket: str) -> None:
    """Forget a data set: its commit records first, then its rows."""
    home = _home(spark, ticket)
    store.delete(spark, f"{home}/commits")
    store.delete(spark, home)
