"""File sources.

One explicit schema on read: nothing is inferred, missing JSON fields come
back as NULL, and the parquet reader gets pushed filters and a pruned
ReadSchema from Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.schema import JSON_TIMESTAMP_FORMAT, READING_JSON_SCHEMA, READINGS_SCHEMA
from vitalis.session import prepare

CORRUPT_COLUMN = "_corrupt_record"


def exists(spark: SparkSession, path: str) -> bool:
    """Path probe through the Hadoop file system of the session (any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hpath)) and len(fs.globStatus(hpath)) > 0


def canonical(df: DataFrame) -> DataFrame:
    """Readings as every operator expects them, whatever shape they come in.

    ``ts`` is filled from ``ts``, ``datetime`` or epoch seconds in ``timestamp``
    (fraction kept), the first that a row has; optional columns that the source
    lacks are added as NULL.  Other columns stay.
    """
    times = []
    for name in ("ts", "datetime"):
        if name in df.columns:
            kind = df.schema[name].dataType
            times.append(F.col(name) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.col(name).cast("timestamp"))
    if "timestamp" in df.columns:
        kind = df.schema["timestamp"].dataType
        times.append(F.timestamp_seconds(F.col("timestamp")) if isinstance(kind, T.NumericType) else F.col("timestamp").cast("timestamp"))
    if len(times) > 1 or times and "ts" not in df.columns:
        df = df.withColumn("ts", F.coalesce(*times))
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in READINGS_SCHEMA if f.name not in df.columns})


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: T.StructType = READING_JSON_SCHEMA,
    mode: str = "FAILFAST",
) -> DataFrame:
    """JSON lines with an explicit schema.

    Blank lines are skipped; a malformed line fails the read (``FAILFAST``,
    as the reference loader raises).  ``mode='PERMISSIVE'`` keeps bad lines
    in ``_corrupt_record`` instead (S19).
    """
    prepare(spark)
    if mode == "PERMISSIVE":
        # read as text and parse: unlike a JSON scan, this may be asked for the bad lines alone, without a cache
        full = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN, "timestampFormat": JSON_TIMESTAMP_FORMAT}
        lines = spark.read.text(path).filter(F.trim("value") != "")
        return canonical(lines.select(F.from_json("value", full, options).alias("r")).select("r.*"))
    reader = spark.read.schema(schema).option("mode", mode).option("timestampFormat", JSON_TIMESTAMP_FORMAT)
    return canonical(reader.json(path))


def read_jsonl_or_empty(spark: SparkSession, path: str, schema: T.StructType = READING_JSON_SCHEMA) -> DataFrame:
    """Like S1, but a missing file gives an empty DataFrame with the schema."""
    if not exists(spark, path):
        return canonical(spark.createDataFrame([], schema))
    return read_jsonl(spark, path, schema)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad raw lines) of a PERMISSIVE read."""
    bad = df.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(CORRUPT_COLUMN)
    good = df.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    return good, bad


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan.  With ``schema``, partition columns keep their types
    (else ``01`` comes back as 1); without it, readings in the shape of the
    JSON records are made canonical."""
    prepare(spark)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    return canonical(df) if {"patient_id", "sensor_type"} <= set(df.columns) else df


def sql_on_parquet(spark: SparkSession, path: str, sql_template: str) -> DataFrame:
    """SQL straight over a Parquet path; ``{src}`` in the template is the relation.

    A missing path raises ``FileNotFoundError`` (the reference returns an
    error value instead).
    """
    prepare(spark)
    if not exists(spark, path):
        raise FileNotFoundError(path)
    quoted = path.replace("`", "``")
    return spark.sql(sql_template.format(src=f"parquet.`{quoted}`"))


def load_preferred(spark: SparkSession, parquet_path: str, jsonl_path: str) -> DataFrame:
    """Parquet when present, else JSON lines (no generated fallback)."""
    if exists(spark, parquet_path):
        return read_parquet(spark, parquet_path)
    if exists(spark, jsonl_path):
        return read_jsonl(spark, jsonl_path)
    raise FileNotFoundError(f"neither {parquet_path} nor {jsonl_path}")
