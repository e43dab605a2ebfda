"""Exact top-k search by columnar branch-and-bound.

Vectors are scaled to whole numbers and searched by inner product.  A batch of
rows lies in memory dimension by dimension (vertical layout).  A query takes the
dimensions block by block, those in which it is largest first, and adds up each
candidate's part of the score.  What the dimensions that are left can add is at
most the product of both vectors' remaining norms (Cauchy-Schwarz).  The k-th
largest lower bound, or the k-th score of earlier batches, is the threshold; a
candidate whose upper bound is below is dropped and the columns are compacted to
those that stay.  After the last block the scores are exact.

Vectors that are null or hold null or non-finite components take no part, nor
do rows with a null id (they couldn't be returned).  Only vectors of the same
length are compared; empty vectors score 0 with each other.  Rows that repeat an
id are candidates of their own; a query is asked once however often its row
repeats, and never finds its own id.  Ties go to smaller ids.  A score beyond the
range of a long is the nearest long.  Empty tables give empty results.  Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm.common import table, written
from vitalis.llm.tiles import EXACT, Best, asked_once, best, matrix, schema_of, tiled, vectors, wide_scores

SCALE = 256
#: Dimensions that are added at a time.
BLOCK = 8
#: Part of the candidates that must fall for the columns to be compacted.
COMPACT = 0.85


def scaled(rows: DataFrame, scale: float = SCALE) -> DataFrame:
    """Append ``y`` = floor(scale * component), held in doubles, and its length ``dim``."""

    def run(batches):
        for batch in batches:
            y = np.floor(scale * batch.column("embedding").flatten().to_numpy(zero_copy_only=False))
            y = np.nan_to_num(y)  # beyond doubles: their largest
            off = np.concatenate([[0], np.cumsum(batch.column("embedding").value_lengths().to_numpy())])
            lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(y, pa.float64()))
            keep = [n for n in batch.schema.names if n != "embedding"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], lists, pa.array(np.diff(off).astype(np.int32))], names=[*keep, "y", "dim"])

    return rows.mapInArrow(run, schema_of(rows.drop("embedding"), "y array<double>, dim int"))


def bounded(y: np.ndarray, mass: np.ndarray, q: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (columns of ``y``) that may be among the ``k`` best and reach ``floor``, with their exact scores.

    ``mass``: squared norm of each block of dimensions of each column.
    """
    parts = [q[b : b + BLOCK] for b in range(0, len(q), BLOCK)]
    own = np.array([float(p @ p) for p in parts])
    order = np.argsort(-own, kind="stable")
    alive, partial = np.arange(y.shape[1]), np.zeros(y.shape[1])
    left, own_left = mass.sum(axis=0), own.sum()
    at = None  # None: all columns
    for step, b in enumerate(order.tolist()):
        cols = y[b * BLOCK : (b + 1) * BLOCK] if at is None else y[b * BLOCK : (b + 1) * BLOCK, at]
        partial = partial + parts[b] @ cols
        left = left - (mass[b] if at is None else mass[b, at])
        own_left -= own[b]
        if step + 1 == len(order):
            break
        more = np.sqrt(np.maximum(left, 0) * max(own_left, 0.0)) + 0.5  # whole numbers: half a unit is slack
        reach = floor
        if len(partial) > k:
            reach = max(floor, float(np.partition(partial - more, len(partial) - k)[len(partial) - k]))
        keep = partial + more >= reach
        if np.count_nonzero(keep) < COMPACT * len(keep):
            alive, partial, left = alive[keep], partial[keep], left[keep]
            at = alive
    top = partial >= floor
    return alive[top], partial[top].astype(np.int64)


class Search:
    """One block of queries against the batches of a group of rows."""

    def __init__(self, k: int):
        self.queries, self.held = [], Best(k)

    def ask(self, batch: pa.RecordBatch) -> None:
        y = matrix(batch.column("y"))
        self.queries += [((i, key, 0), v, float(np.linalg.norm(v))) for i, key, v in zip(batch.column("id").to_pylist(), batch.column("qkey").to_pylist(), y, strict=True)]

    def see(self, batch: pa.RecordBatch) -> None:
        if not self.queries:
            return
        ids, y = batch.column("id").to_numpy(), matrix(batch.column("y"))
        with np.errstate(over="ignore"):
            norm = np.linalg.norm(y, axis=1)
        columns = np.ascontiguousarray(y.T)
        blocks = range(0, max(1, y.shape[1]), BLOCK)
        with np.errstate(over="ignore"):
            mass = np.stack([(columns[b : b + BLOCK] ** 2).sum(axis=0) for b in blocks])
        most = float(norm.max(initial=0.0))
        for at, q, length in self.queries:
            own = ids != at[0]
            wide = None
            if not most * length < EXACT:
                wide = ~(norm * length < EXACT)
                own &= ~wide
            if own.all():
                rows, scores = bounded(columns, mass, q, self.held.k, self.held.floor(at))
                self.held.add(at, scores, ids[rows])
            else:
                some = np.flatnonzero(own)
                rows, scores = bounded(columns[:, some], mass[:, some], q, self.held.k, self.held.floor(at))
                self.held.add(at, scores, ids[some[rows]])
            if wide is not None and (far := np.flatnonzero(wide & (ids != at[0]))).size:
                self.held.add(at, np.array(wide_scores(y[far], q), np.int64), ids[far])

    def found(self) -> pa.RecordBatch:
        return self.held.batch()


def top_k(df: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """The ``k`` rows of highest inner product for each row that ``is_query`` (a condition on ``id``) picks.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``.
    """
    rows = written(scaled(vectors(df, key, vector), scale), "vectors")
    queries = asked_once(rows.filter(is_query))
    found = best(tiled(rows, queries, lambda: Search(k)), k)
    return found.select(F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("other").alias("vec_id"), "score")


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 50 == 0)


__all__ = ["op13_topk", "top_k"]
