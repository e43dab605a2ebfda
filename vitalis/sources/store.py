"""Small metadata files and folders of the shared store, by any file system that Spark reaches.

Only names, sizes and texts of a few hundred bytes pass through the driver here; data files are
read and written by Spark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it doesn't exist)."""
    fs, p = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder, from the file system's own records."""
    fs, p = _at(spark, path)
    return int(fs.getContentSummary(p).getLength())


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; False if it wasn't there."""
    fs, p = _at(spark, path)
    return bool(fs.delete(p, True))


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that readers see whole or not at all (a hidden file, then a rename)."""
    fs, p = _at(spark, path)
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    fs.mkdirs(p.getParent())
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(hidden, p):
        fs.delete(hidden, False)
        raise OSError(f"could not publish {path}")
