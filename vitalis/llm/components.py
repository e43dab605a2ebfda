"""Connected components, and dealing out groups that may be large."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalis.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """Smallest id reachable from each id of ``edges`` (columns ``a``, ``b``): columns ``id``, ``component``.

    Alternates large-star and small-star steps until the edges stay as they are.  Every step is a
    pre-aggregated minimum by node and a join with it, whose large nodes Spark can split; each
    round's edges are written to the shared folder, and the driver sees only their count and checksum.
    """
    pairs = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, mark = written(pairs, "edges"), None
    while (new := tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())) != mark:
        mark = new
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.filter("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = written(small.distinct(), "edges")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots).distinct()


def deal(rows: DataFrame, group: str, cost: str, most_cost: int, most_rows: int) -> DataFrame:
    """Append ``pile`` and ``side`` to the rows of groups whose members are to be compared with each other.

    Whole groups of up to ``most_cost`` (sum of ``cost``) and ``most_rows`` rows share piles of about
    that size (side 0).  A larger group is cut into blocks by a hash of ``id``, and each pair of blocks
    makes a pile of its own: side 1 rows are to be compared with side 2 rows, and side 0 rows with each other.
    """
    totals = rows.groupBy(group).agg(F.sum(cost).alias("__cost"), F.count(F.lit(1)).alias("__rows"))
    blocks = F.greatest(F.ceil(F.col("__cost") * 2 / most_cost), F.ceil(F.col("__rows") * 2 / most_rows))
    whole = (F.col("__cost") <= most_cost) & (F.col("__rows") <= most_rows)
    sized = written(totals.select(group, F.when(whole, F.lit(0)).otherwise(blocks).cast("int").alias("__blocks"), "__cost", "__rows"), "groups")
    small = sized.filter("`__blocks` = 0").agg(F.sum("__cost"), F.sum("__rows")).first()  # one row
    piles = max(1, int((small[0] or 0) / most_cost * 2), int((small[1] or 0) / most_rows * 2))
    tagged = rows.join(sized.drop("__cost", "__rows"), group)
    together = tagged.filter("`__blocks` = 0").select(*rows.columns, F.pmod(F.xxhash64(F.col(group)), F.lit(piles)).alias("pile"), F.lit(0).alias("side"))
    block = F.pmod(F.xxhash64(F.col("id"), F.lit(11)), F.col("__blocks")).cast("int")
    apart = tagged.filter("`__blocks` > 0").withColumn("__block", block).withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    pile = F.xxhash64(F.col(group), F.least("__block", "__other"), F.greatest("__block", "__other"), F.lit("pair"))
    side = F.when(F.col("__block") == F.col("__other"), 0).when(F.col("__block") < F.col("__other"), 1).otherwise(2)
    return together.union(apart.select(*rows.columns, pile.alias("pile"), side.alias("side")))


def roots_of(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each row of a boolean, symmetric matrix of links."""
    a, b = np.nonzero(np.triu(linked, 1))
    root = np.arange(len(linked))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new
