"""Duplicate removal across all history (D1, D5 without a time limit).

A stream's state forgets a key once the watermark has passed it.  Here the
keys of all rows ever kept are a table, bucketed by a hash of the key, next to the
rows.  A new batch is cleaned, dealt to the same buckets and anti-joined; the
stored side is read bucket by bucket and never shuffled, so a batch costs its own shuffle and a scan of the
keys, however long the history is.

A batch has an id.  Its rows go to a folder of that id, and its keys are
appended afterwards.  Keys of the same id don't count against it, so a batch that
is run again after a crash gives the same rows again and stores nothing twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.operators.clean import DEDUP_KEY, dedupe
from vitalis.sources import store


class History:
    """Rows kept so far, under ``path``, and the bucketed table ``name`` of their keys."""

    def __init__(self, spark: SparkSession, name: str, path: str, key: list[str] | None = None, buckets: int = 64):
        self.spark, self.name, self.path, self.key, self.buckets = spark, name, path.rstrip("/"), key or DEDUP_KEY, buckets

    def _hash(self) -> Column:
        return F.xxhash64(*self.key)

    def new_rows(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows of ``batch``, one per key, whose key no other batch has (NULL keys are keys)."""
        fresh = dedupe(batch, self.key).withColumn("_hash", self._hash())
        if not self.spark.catalog.tableExists(self.name):
            return fresh.drop("_hash")
        known = self.spark.table(self.name).filter(F.col("_batch") != batch_id)
        # the buckets' hash alone is the join key; that the keys agree is checked on the pairs that it makes, as a
        # count, because plain equalities would become join keys, too, and ask for a shuffle of both sides
        agree = sum((F.col(f"f.{c}").eqNullSafe(F.col(f"k.{c}")).cast("int") for c in self.key), F.lit(0))
        same = (F.col("f._hash") == F.col("k._hash")) & (agree == len(self.key))
        return fresh.alias("f").join(known.alias("k"), same, "left_anti").drop("_hash")

    def add(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Store the new rows of a batch and return them."""
        folder = f"{self.path}/rows/batch={int(batch_id)}"
        new = self.new_rows(batch, batch_id)
        new.write.mode("overwrite").parquet(folder)
        stored = self.spark.read.schema(new.schema).parquet(folder)
        if not self._has(batch_id):
            keys = stored.select(self._hash().alias("_hash"), *self.key, F.lit(int(batch_id)).cast("long").alias("_batch"))
            dealt = keys.repartition(self.buckets, "_hash")  # one file a bucket
            writer = dealt.write.mode("append").format("parquet").bucketBy(self.buckets, "_hash").sortBy("_hash")
            if not self.spark.catalog.tableExists(self.name):
                writer = writer.option("path", f"{self.path}/keys-{uuid.uuid4().hex}")
            writer.saveAsTable(self.name)
            store.publish_text(self.spark, f"{self.path}/done/{int(batch_id)}", "")
        return stored

    def _has(self, batch_id: int) -> bool:
        """Have the batch's keys been stored?  If a crash came in between, they are stored once more, which does no harm."""
        return str(int(batch_id)) in store.names(self.spark, f"{self.path}/done")

    def compact(self) -> None:
        """Rewrite the key table with one sorted file a bucket, once many batches have left many small ones.

        The new table is complete before the old one goes; if a crash comes in between, the next call ends the change.
        """
        spare = f"{self.name}_compact"
        if self.spark.catalog.tableExists(self.name):
            self.spark.sql(f"DROP TABLE IF EXISTS {spare}")
            folder = f"{self.path}/keys-{uuid.uuid4().hex}"
            keys = self.spark.table(self.name).dropDuplicates(["_hash", *self.key, "_batch"]).repartition(self.buckets, "_hash")
            keys.write.format("parquet").bucketBy(self.buckets, "_hash").sortBy("_hash").option("path", folder).saveAsTable(spare)
            self.spark.sql(f"DROP TABLE {self.name}")
        if self.spark.catalog.tableExists(spare):
            self.spark.sql(f"ALTER TABLE {spare} RENAME TO {self.name}")
            used = {f.rsplit("/", 2)[-2] for f in self.spark.table(self.name).inputFiles()}
            for folder in store.names(self.spark, self.path):
                if folder.startswith("keys-") and folder not in used:
                    store.delete(self.spark, f"{self.path}/{folder}")

    def rows(self) -> DataFrame:
        """All rows kept so far (``batch`` tells which batch brought them)."""
        return self.spark.read.parquet(f"{self.path}/rows")


__all__ = ["History"]
