"""WARC archives with revisit resolution.

Headers (digest, size, id) are shuffled by payload digest; of the records with
equal payloads the one with the smallest id becomes the ``response``, all
others become ``revisit`` records that name it.  The archives hold fresh
headers for every record and the payload of responses only.  Reading parses
the archives by their content lengths and joins the revisits to the responses
they refer to.

Records are written by Spark's text writer with two CRLFs behind each record,
as the format asks for, so the write is committed file by file and survives
lost executors; any file system that Spark reaches will do.

Nulls: a null payload is an empty one, a null url an absent header.  Rows with
a null id are revisits of the smallest id with their payload, and responses if
there is none.  Rows that repeat both id and payload stay records of their
own.  Payloads of any length and content are allowed, and payloads shorter
than ``least`` bytes are all responses.  An empty table gives no archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm.common import add_columns, table, without
from vitalis.session import scratch_path

CRLF = "\r\n"
DATE = "2024-05-01T00:00:00Z"
#: Records of an archive, at most, and bytes of its payloads; payloads that count as long go to archives of their own.
FILE_RECORDS, FILE_BYTES, LONG_BYTES = 1000, 256 << 20, 256 << 10


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_digest(df: DataFrame, payload: str) -> DataFrame:
    """Append ``payload_digest`` (SHA-1 in base 32) and ``payload_bytes`` of the payload in UTF-8."""

    def make():
        def f(batch):
            raw = batch.column(payload).cast(pa.binary()).fill_null(b"")
            return pa.array([digest(x.as_buffer()) for x in raw], pa.string()), pc.binary_length(raw).cast(pa.int64())

        return f

    return add_columns(df, "payload_digest string, payload_bytes long", payload, make)


def resolve(records: DataFrame, key: str = "id", least: int = 0) -> DataFrame:
    """Append ``record_type`` and ``refers_to`` by payload digest."""
    rows = without(records, ["record_type", "refers_to"])
    first = rows.filter(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("__digest")).agg(F.min(key).alias("__first"))
    paired = rows.join(first, F.col("payload_digest") == F.col("__digest"), "left")
    again = F.col("__first").isNotNull() & ~F.col("__first").eqNullSafe(F.col(key))
    return paired.select(*[F.col(f"`{c}`") for c in rows.columns], F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("__first")).alias("refers_to"))


def write_archives(df: DataFrame, path: str, key: str, url: str, payload: str, least: int = 0) -> None:
    """Write a record for each row of ``df``, payloads once, to gzipped archives under ``path``."""
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload"))
    records = resolve(with_digest(rows, "payload"), "id", least)
    is_first = F.col("record_type") == "response"

    def line(name: str, value) -> object:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{CRLF}{name}: "), value)).otherwise("")

    block = F.when(is_first, F.col("payload")).otherwise("")
    header = F.concat(
        F.lit("WARC/1.0"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.coalesce(F.concat(F.lit("<urn:page:"), F.col("id").cast("string"), F.lit(">")), F.lit("<urn:page:>"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        line("WARC-Profile", F.when(~is_first, F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    lines = records.select("payload_bytes", F.concat(header, F.lit(CRLF + CRLF), block).alias("value"))
    # a reader takes an archive as one value, so its bytes are bounded, too: long payloads are written few to a file
    longest = rows.agg(F.max(F.octet_length("payload"))).first()[0] or 0
    for some, most in ((F.col("payload_bytes") <= LONG_BYTES, FILE_RECORDS), (F.col("payload_bytes") > LONG_BYTES, max(1, FILE_BYTES // max(1, longest)))):
        if most == FILE_RECORDS or longest > LONG_BYTES:
            lines.filter(some).select("value").write.mode("append").option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", most).option("compression", "gzip").text(path)


_HEADER = re.compile(rb"([A-Za-z-]+): (.*)\r\n")


def parse(stream):
    """Records of an open archive, one at a time: (headers, block)."""
    while line := stream.readline():
        if line != b"WARC/1.0\r\n":
            raise ValueError(f"no record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            found = _HEADER.fullmatch(line)
            headers[found[1].decode()] = found[2].decode()
        length = int(headers["Content-Length"])
        block = stream.read(length)
        if len(block) < length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{headers['WARC-Record-ID']} doesn't end where it should")
        yield headers, block


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives under ``path``: id, url, record_type, payload_digest, refers_to, block."""
    schema = T.StructType([T.StructField(n, t, True) for n, t in (("id", T.LongType()), ("url", T.StringType()), ("record_type", T.StringType()), ("payload_digest", T.StringType()), ("refers_to", T.LongType()), ("block", T.StringType()))])

    def number(urn: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
        return int(found[1]) if found else None

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                out, size = [], 0
                for h, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer())))):
                    out.append((number(h["WARC-Record-ID"]), h.get("WARC-Target-URI"), h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:"), number(h.get("WARC-Refers-To")), block.decode()))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=ARROW)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, schema)


ARROW = pa.schema([("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("block", pa.string())])


def resolved(records: DataFrame) -> DataFrame:
    """Records as read, with ``payload_bytes`` of the full payload: a revisit has that of the response it refers to.

    Only headers move: the size of each response's block by its id and digest.
    """
    heads = records.select("id", "record_type", "payload_digest", "refers_to", F.octet_length("block").cast("long").alias("block_bytes"))
    originals = heads.filter("record_type = 'response'").groupBy(F.col("id").alias("of"), F.col("payload_digest").alias("digest")).agg(F.max("block_bytes").alias("full"))
    joined = heads.join(originals, (F.col("refers_to") == F.col("of")) & (F.col("payload_digest") == F.col("digest")), "left")
    return joined.select("id", "record_type", "payload_digest", "refers_to", F.when(F.col("record_type") == "response", F.col("block_bytes")).otherwise(F.col("full")).alias("payload_bytes"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), path, "page_id", "url", "html")
    got = resolved(read_archives(spark, path))
    return got.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
