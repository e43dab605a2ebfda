"""Sharding by a two-pass external shuffle.

Pass one scatters the records by seeded hashes: the key and the number of
shards decide the shard (highest random weight, so one more shard takes rows
only into itself), a second hash the bucket inside it.  The number of buckets
follows the bytes of each shard so that a bucket fits in memory; rows alike that fill more than
one are dealt to several.  Pass two permutes each
bucket by Spark's ``shuffle`` function, a seeded Fisher-Yates shuffle, and
writes it.  The place of a record in its shard is the number of records in
the buckets before plus its place in the bucket.

Nulls: a null text has size 16 and no checksum; rows with a null key share a
shard, and their texts spread them over its buckets.  Repeated rows are rows
of their own; which of them comes first may change from run to run.  An empty table gives empty shards.  Columns with the names of
the output columns are replaced; columns must be of sortable types (no map).
Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm.common import table, without, written
from vitalis.session import scratch_path

SEED = 20_240_501
#: Bytes of records that a bucket should hold.
BUCKET_BYTES = 16 << 20


def weight_of(key: Column, shard: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key, shard)


def shard_of(key: Column, n_shards: int, seed: int = SEED) -> Column:
    """The shard with the highest seeded weight for ``key``: struct(weight, shard)."""
    shards = F.sequence(F.lit(0), F.lit(n_shards - 1))
    return F.array_max(F.transform(shards, lambda s: F.struct(weight_of(key, s, seed).alias("weight"), s.alias("shard"))))


def write_shards(df: DataFrame, path: str, key: str = "doc_id", size: str = "size", spread: str = "text_crc32", n_shards: int = 40, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Shuffle the rows of ``df`` into shards and write them as Parquet, one folder per shard.

    ``size`` (bytes of a row) sets the number of buckets of each shard; ``spread`` tells rows with one key apart.
    Rows that agree in both and fill more than a bucket are dealt to as many buckets as they fill.
    """
    rows = without(df, ["shard", "grown_shard", "bucket", "place"])
    names = [F.col(f"`{c}`") for c in rows.columns]
    alike = written(rows.groupBy(F.col(key).alias("k"), F.col(spread).alias("spread")).agg(F.sum(size).alias("bytes")), "sizes")
    best = shard_of(F.col(key), n_shards, seed)
    grown = weight_of(F.col(key), F.lit(n_shards), seed)
    held = {r["shard"]: r["bytes"] for r in alike.groupBy(shard_of(F.col("k"), n_shards, seed)["shard"].alias("shard")).agg(F.sum("bytes").alias("bytes")).collect()}  # a row a shard
    buckets = F.array(*[F.lit(max(1, math.ceil((held.get(i) or 0) / bucket_bytes))) for i in range(n_shards)])
    large = written(alike.filter(F.col("bytes") > bucket_bytes).select("k", "spread", F.ceil(F.col("bytes") / bucket_bytes).cast("int").alias("parts")), "large")
    scattered = rows.select(F.struct(F.col(key).alias("k"), F.struct(*names).alias("row")).alias("record"), F.col(spread).alias("spread"), best.alias("best"), grown.alias("grown"))
    told = scattered.alias("s").join(large.alias("l"), F.col("s.record.k").eqNullSafe(F.col("l.k")) & F.col("s.spread").eqNullSafe(F.col("l.spread")), "left")
    salt = F.floor(F.rand(seed) * F.coalesce("parts", F.lit(1))).cast("int")  # 0 for all but large groups of rows that are alike
    record = F.struct(F.col("record.*"), F.when(F.col("grown") > F.col("best.weight"), F.lit(n_shards)).otherwise(F.col("best.shard")).alias("grown_shard"))
    n = F.element_at(buckets, F.col("best.shard") + 1)
    bucket = F.pmod(F.pmod(F.xxhash64(F.lit(seed + 1), F.col("record.k"), F.col("s.spread")), n) + salt, n).cast("int")
    dealt = told.select(F.col("best.shard").alias("shard"), bucket.alias("bucket"), record.alias("record")).groupBy("shard", "bucket").agg(F.collect_list("record").alias("records"))
    permuted = dealt.select("shard", "bucket", F.posexplode(F.shuffle(F.sort_array("records"), F.lit(seed))).alias("place", "record"))
    permuted.select("record.row.*", "record.grown_shard", "bucket", "place", "shard").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, rows: DataFrame, *columns: Column) -> DataFrame:
    """Written shards with ``slot``, the gapless place of each row in its shard.

    ``columns`` of the stored rows to return (default: all), with ``grown_shard``, ``shard`` and ``slot``: they are computed
    before rows meet their bucket's offset, so that long texts needn't travel again.
    """
    schema = without(rows, ["shard", "grown_shard", "bucket", "place", "slot"]).schema
    own = [F.col(f"`{c}`") for c in schema.names]
    for name in ("grown_shard", "bucket", "place", "shard"):
        schema = schema.add(name, T.IntegerType())
    stored = spark.read.schema(schema).parquet(path)
    counts = stored.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    offsets = counts.select("shard", "bucket", before.alias("before"))
    light = stored.select(*(columns or own), "grown_shard", "bucket", "place", "shard")
    return light.join(offsets, ["shard", "bucket"]).withColumn("slot", F.col("before") + F.col("place")).drop("before", "bucket", "place")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    crc = F.crc32(F.col("text").cast("binary"))
    sized = without(docs, ["size", "text_crc32"]).select("*", size.alias("size"), crc.alias("text_crc32"))
    path = scratch_path(spark, "shards")
    write_shards(sized, path)
    got = read_shards(spark, path, sized, F.col("doc_id"), size.alias("size"), crc.alias("text_crc32"))  # of the text as written
    return got.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
