"""Stated queries against all rows, in tiles: blocks of queries times groups of rows.

Every tile is one partition: its queries come first, then its rows stream by in
Arrow batches, so a task holds one block of queries and one batch of rows,
however long the table is.  A tile returns the best of each query; Spark merges
them by rank.  Rows travel once for each block of queries and queries once for
each group of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Queries of a block, at most about; rows that make another group worth its copies of the queries.
QUERIES, ROWS = 8_192, 8_192
#: Norms whose product stays below give inner products that doubles hold exactly.
EXACT = float(1 << 52)
#: What a tile returns: the query (``id`` and ``qkey``), which of its lists, and a row with its score.
FOUND = "id long, qkey long, band int, other long, score long"


def vectors(df: DataFrame, key: str, vector: str, label: str | None = None) -> DataFrame:
    """Rows that take part: ``id``, ``embedding`` as doubles (and ``label`` as text, not null)."""
    v = F.col("embedding")
    out = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("embedding"), *([F.col(f"`{label}`").cast("string").alias("label")] if label else []))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    out = out.filter(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
    return out.filter(F.col("label").isNotNull()) if label else out


def matrix(arr: pa.Array) -> np.ndarray:
    """Rows of a list array of equal lengths."""
    return arr.flatten().to_numpy(zero_copy_only=False).reshape(len(arr), -1)


def tiled(rows: DataFrame, queries: DataFrame, kernel: Callable, block: int | None = None, group: int | None = None) -> DataFrame:
    """Run ``kernel()`` on each tile and each length of vectors (column ``dim`` of both): rows of :data:`FOUND`.

    A kernel has ``ask(batch)`` for queries, ``see(batch)`` for rows and ``found()`` for its result.
    """
    spark = rows.sparkSession
    n, q = rows.count(), queries.count()
    blocks = max(1, math.ceil(q / (block or QUERIES)))
    groups = max(1, min(math.ceil(n / (group or ROWS)), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    own = lambda c, n, seed: F.pmod(F.xxhash64(F.lit(seed), c), F.lit(n)).cast("int")
    asked = queries.withColumn("__g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumns({"kind": F.lit(0), "tile": F.col("__g") * blocks + own(F.col("id"), blocks, 1)})
    seen = rows.withColumn("__h", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumns({"kind": F.lit(1), "tile": own(F.col("id"), groups, 2) * blocks + F.col("__h")})
    both = asked.drop("__g").unionByName(seen.drop("__h"), allowMissingColumns=True)
    dealt = both.repartitionById(groups * blocks, F.col("tile")).sortWithinPartitions("tile", "dim", "kind")

    def run(batches):
        now, held = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("tile", "dim", "kind")], axis=1).reshape(batch.num_rows, 3)
            ends = np.append(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1, len(keys))
            at = 0
            for to in ends.tolist():
                if to > at:
                    if now != (mark := tuple(keys[at, :2])):
                        if held is not None:
                            yield held.found()
                        now, held = mark, kernel()
                    (held.see if keys[at, 2] else held.ask)(batch.slice(at, to - at))
                at = to
        if held is not None:
            yield held.found()

    return dealt.mapInArrow(run, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each list of each query over all tiles, with ``rank`` from 1; ties go to smaller ids."""
    place = Window.partitionBy("id", "qkey", "band").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def long_of(x: int) -> int:
    """A score as a long; beyond its range, the nearest one."""
    return max(-(1 << 63), min((1 << 63) - 1, x))


def wide_scores(rows: np.ndarray, q: np.ndarray) -> list[int]:
    """Inner products too large for doubles, in whole numbers."""
    whole = [int(x) for x in q]
    return [long_of(sum(int(a) * b for a, b in zip(r, whole, strict=True))) for r in rows]


class Best:
    """Running lists of the ``k`` best (score, row) of each query, kept sorted."""

    def __init__(self, k: int):
        self.k, self.lists = k, {}

    def floor(self, at: tuple) -> float:
        """What a further score must reach."""
        have = self.lists.get(at)
        return have[0][-1] if have is not None and len(have[0]) == self.k else -math.inf

    def add(self, at: tuple, scores: np.ndarray, ids: np.ndarray) -> None:
        if at in self.lists:
            scores, ids = np.concatenate([self.lists[at][0], scores]), np.concatenate([self.lists[at][1], ids])
        if len(scores):
            order = np.lexsort((ids, ~scores))[: self.k]  # not -scores: the least long has no opposite
            self.lists[at] = scores[order], ids[order]

    def batch(self) -> pa.RecordBatch:
        """All lists; their keys are (id, qkey, band)."""
        keys = np.repeat(np.array([*self.lists], np.int64).reshape(-1, 3), [len(v[0]) for v in self.lists.values()], axis=0)
        score = np.concatenate([v[0] for v in self.lists.values()] or [np.zeros(0, np.int64)]).astype(np.int64)
        other = np.concatenate([v[1] for v in self.lists.values()] or [np.zeros(0, np.int64)]).astype(np.int64)
        cols = [keys[:, 0], keys[:, 1], keys[:, 2].astype(np.int32), other, score]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["id", "qkey", "band", "other", "score"])


def asked_once(rows: DataFrame) -> DataFrame:
    """Queries, each once however often its row repeats, with ``qkey`` to tell rows of one id apart."""
    same = [c for c in ("label", "y") if c in rows.columns]
    return rows.dropDuplicates(["id", *same]).withColumn("qkey", F.xxhash64(*same))


def schema_of(df: DataFrame, more: str) -> T.StructType:
    return T.StructType([*df.schema.fields, *T._parse_datatype_string(more).fields])
