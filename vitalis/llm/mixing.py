"""Mixing sources to target weights: capped water-filling.

Every source gets a share of the budget by its weight, at most ``epochs``
times its own size.  What a clamped source cannot take is dealt out again to
the others by weight, until no share is above its limit.  With the sources in
order of limit / weight, that fixpoint has one water level, found by running
sums over the small table of sources.

A source then repeats each document ``floor(target / size)`` whole times.  The
rest is one fractional repetition: the documents in a seeded order up to the
word where the target is met, so a source's words meet its target to a word.
Running sums go by hash bucket first, so no task sorts a whole source.

Nulls: a null text has size 0 (it is taken with 0 words), a null source is a
source of its own and the last one.  Documents without words, repeated rows
(each counts for itself) and equal hashes are fine.  An empty table gives an
empty mix.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalis.llm.common import GAP, table, without, written

#: Hex digits of the seeded hash that name a bucket: 4096 buckets a source.
DIGITS = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of words (runs without ASCII white space); 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, GAP), "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[float], share: float, epochs: float) -> DataFrame:
    """Target of each source by capped water-filling.

    ``sizes`` has one row per ``source`` with ``source_size``; weights repeat in order of the sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    limited = sizes.select("source", "source_size", w.alias("weight"), rank.alias("rank"), (F.col("source_size") * F.lit(float(epochs))).alias("most"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = limited.select(
        "*",
        F.row_number().over(order).alias("place"),
        ((F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)).alias("level"),
    ).withColumn("free", F.col("level") * F.col("weight") < F.col("most"))
    water = levels.select(
        "*",
        F.min(F.when(F.col("free"), F.col("place"))).over(everything).alias("first_free"),
        F.min(F.when(F.col("free"), F.struct("place", "level"))).over(everything)["level"].alias("water"),
    )
    is_free = F.col("first_free").isNotNull() & (F.col("place") >= F.col("first_free"))
    return water.select("source", "source_size", F.when(is_free, F.least(F.col("water") * F.col("weight"), F.col("most"))).otherwise(F.col("most")).alias("target"))


def mix_sources(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: str = "size",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    epochs: float = 2.0,
    seed: str = SEED,
) -> DataFrame:
    """Append ``source_size``, ``target`` and ``taken`` (words the mix takes of a row, repeats counted).

    ``df`` is read three times (sums by source, sums by bucket, rows), so give a written or cheap
    one.  Columns of ``df`` that have these names are replaced.
    """
    kept = without(df, ["source_size", "target", "taken"])
    names = [F.col(f"`{c}`") for c in kept.columns]
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))))
    rows = kept.select(
        F.struct(*names).alias("row"), F.col(f"`{source}`").alias("source"), F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("long").alias("size"),
        digest.alias("at"), F.substring(digest, 1, DIGITS).alias("bucket"),
    )
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    goal = targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), list(weights), share, epochs)
    goal = goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goal = goal.withColumn("rest", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
    start = F.sum("bucket_size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("bucket_size")
    offsets = sums.withColumn("start", start).select("source", "bucket", "start")
    plan = offsets.alias("o").join(goal.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source"))).select("o.source", "bucket", "start", "source_size", "target", "whole", "rest")
    within = Window.partitionBy("source", "bucket").orderBy("at", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("upto", F.sum("size").over(within)).alias("r")
    both = placed.join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.bucket") == F.col("p.bucket")))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start") - F.col("upto") + F.col("size")))
    return both.select("row.*", "source_size", "target", (F.col("whole") * F.col("size") + extra).cast("long").alias("taken"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix")
    return mix_sources(sized).select("doc_id", "size", "source_size", "target", "taken")


#: The same by SQL: md5 order, so even the fractional repetition agrees.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS at
  FROM documents),
s AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM d GROUP BY source),
l AS (
  SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 2.0::DOUBLE * source_size AS most FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY most / w, rk) AS place,
         ((SELECT SUM(source_size) FROM s)::DOUBLE * 1.5::DOUBLE - COALESCE(SUM(most) OVER (ORDER BY most / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / SUM(w) OVER (ORDER BY most / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM l),
f AS (SELECT MIN(place) AS first_free, arg_min(level, place) AS water FROM o WHERE level * w < most),
t AS (SELECT source, source_size, CASE WHEN place >= first_free THEN LEAST(water * w, most) ELSE most END AS target FROM o LEFT JOIN f ON TRUE),
g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.whole, CAST(round(g.target) AS BIGINT) - g.whole * g.source_size AS rest,
         SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.at, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + GREATEST(0, LEAST(size, rest - upto + size)) AS BIGINT) AS taken FROM r
"""
