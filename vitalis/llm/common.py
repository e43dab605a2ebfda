"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.session import scratch_path

#: White space between words, as a Java regular expression.
GAP = r"[\x20\x09-\x0D]+"
#: Bytes of text that one step of a Python function works on.
SLICE_BYTES = 8 << 20

_WS = np.zeros(256, dtype=bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A table of the data folder, by a path that only Spark has to reach."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def written(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    The rows are on the file system that ``spark.checkpoint.dir`` names, so a
    lost executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Size estimate of a plan from file sizes; steers partition counts only, never results."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) if int(str(size)) < 1 << 62 else 1 << 40


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns that an operator is about to add (case-insensitive, as Spark resolves names)."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def slices(batch: pa.RecordBatch, col: str, most: int = SLICE_BYTES):
    """Cut a batch into runs of rows of about ``most`` bytes of ``col`` (one row at least)."""
    arr = batch.column(col)
    if not len(arr):
        return
    off = np.frombuffer(arr.buffers()[1], np.int64 if pa.types.is_large_string(arr.type) else np.int32)
    off = off[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    at = 0
    while at < len(arr):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def add_columns(df: DataFrame, new: str, text: str, make, most: int = SLICE_BYTES) -> DataFrame:
    """Append columns computed by Python from Arrow batches.

    ``make()`` runs once in each task and returns ``f(batch) -> arrays`` in the order of the DDL
    string ``new``.  Columns of ``df`` with those names are replaced.
    """
    fields = T._parse_datatype_string(new)
    if isinstance(fields, T.StructType):
        names = fields.names
    base = without(df, names)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in [*base.schema, *fields]])

    def run(batches):
        f = make()
        for batch in batches:
            for part in slices(batch, text, most):
                yield pa.RecordBatch.from_arrays([*part.columns, *f(part)], names=[*part.schema.names, *names])

    return base.mapInArrow(run, schema)


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string array and the place where each starts (nulls count as empty)."""
    if arr.null_count:
        arr = arr.fill_null("")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64 if pa.types.is_large_string(arr.type) else np.int32)
    off = off[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(arr.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def split_words(arr: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words (maximal runs without ASCII white space) of all texts, and the first word of each text.

    Returns a binary array of words in order, and ``first`` with one entry more than there are texts.
    """
    data, off = text_buffer(arr)
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(off), np.int64)
    ink = ~_WS[data]
    start = ink.copy()
    start[1:] &= ~ink[:-1]
    heads = off[:-1][off[:-1] < len(data)]
    start[heads] = ink[heads]
    at = np.flatnonzero(start)
    kept = np.concatenate([[0], np.cumsum(ink)])
    ends = np.append(kept[at], kept[-1]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[ink]))])
    return words, np.searchsorted(at, off).astype(np.int64)


_HASHED: dict[bytes, int] = {}


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every task."""
    import xxhash

    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    if len(_HASHED) > 300_000:  # a memo only
        _HASHED.clear()
    hashed = np.empty(len(coded.dictionary), np.uint64)
    for i, w in enumerate(coded.dictionary.to_pylist()):
        h = _HASHED.get(w)
        if h is None:
            h = _HASHED[w] = xxhash.xxh3_64_intdigest(w)
        hashed[i] = h
    return hashed[coded.indices.to_numpy()]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gram_hashes(h: np.ndarray, k: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of each run of ``k`` values of ``h`` (entry i: values i to i+k-1), by doubling."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out, size, power, span, step = None, 0, 1, h, 1
        bits = k
        base_power = base  # base ** step
        while True:
            if bits & 1:
                if out is None:
                    out, size, power = span, step, base_power
                else:  # out covers `size` values; put `span` of `step` values behind it
                    n = len(h) - size - step + 1
                    out = out[:n] * np.uint64(base_power) + span[size : size + n]
                    size += step
            bits >>= 1
            if not bits:
                break
            n = len(h) - 2 * step + 1
            span = span[:n] * np.uint64(base_power) + span[step : step + n]
            base_power = base_power * base_power & (1 << 64) - 1
            step *= 2
        return mix(out)


def letters(text: str) -> list[str]:
    """Runs of letters, in lower case; numerals such as a half, a superscript two or a Roman eight are none."""
    out = []
    for run in _LETTERS.findall(text.lower()):
        out += [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split()
    return out


_LETTERS = re.compile(r"[^\W\d_]+")
