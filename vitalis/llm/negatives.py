"""Hard-negative mining by rotated one-bit codes.

Vectors are scaled to whole numbers.  Each one is rotated at random and coded by
the signs of its coordinates, and its alignment with the code vector (their
inner product) is stored; what the code leaves of the vector is rotated and
coded again, ``LEVELS`` times in all.  The code is written once, next to the row.

A query's rotated coordinates are rounded to ``BITS`` bits, so its inner product
with a code is a sum of popcounts over bit planes.  The alignments turn these
into an estimate of the score.  What is left over is bounded by Cauchy-Schwarz:
the part of the query across the code times the norm of what the code leaves, plus
the rounding of the query.  So a score surely lies in its interval.  Candidates
whose interval misses every wanted band, or lies below the k-th best that is
sure, fall level by level; the scores of those that survive are computed in whole
numbers.  Nothing depends on chance but the number of survivors.

An anchor's positives are the first rows of its label; a positive's negatives the
first rows of other labels whose score is between two percentages of the
positive's.  Both come from the same search, the first with one band without ends,
the second with a band for each positive.

Rows with a null label, a null vector, any null or non-finite component or a null
id take no part.  Only vectors of the same length are compared; empty vectors
score 0 with each other.  Rows that repeat an id are rows of their own, but an
anchor is asked once and never finds its own id.  Ties go to smaller ids.  A band
that is empty, as for a negative positive score, has no negatives.  Scores beyond
the range of a long are the nearest long.  Empty tables give empty results.
Other columns are not read.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm.common import table, written
from vitalis.llm.tiles import EXACT, Best, asked_once, best, matrix, schema_of, tiled, vectors, wide_scores
from vitalis.llm.topk import SCALE, scaled

#: Codes of a vector, each of what the ones before leave; bits that a query's coordinates are rounded to.
LEVELS, BITS = 4, 6
SEED = 20_240_501


@functools.lru_cache(maxsize=64)
def rotation(level: int, dim: int) -> np.ndarray:
    """A random rotation (fixed by the level and the length)."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, level, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    pad = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1, bitorder="little").view(np.uint64)


def encode(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (row, level, word), alignments (row, level) and norms of what is left (row, level + 1)."""
    n, dim = y.shape
    codes, along, left = [], [], [np.linalg.norm(y, axis=1)]
    rest = y
    for level in range(LEVELS):
        z = rest @ rotation(level, dim)
        up = z >= 0
        sign = np.where(up, 1.0, -1.0) / math.sqrt(dim)
        a = np.einsum("ij,ij->i", z, sign)
        rest = z - a[:, None] * sign
        codes.append(packed(up))
        along.append(a)
        left.append(np.linalg.norm(rest, axis=1))
    return np.stack(codes, axis=1), np.stack(along, axis=1), np.stack(left, axis=1)


def coded(rows: DataFrame) -> DataFrame:
    """Append ``code`` (64-bit words, level by level), ``along`` and ``left`` to rows with ``y`` and ``dim``."""

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            code, along, left = ([None] * batch.num_rows for _ in range(3))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                with np.errstate(all="ignore"):  # numbers beyond doubles are scored without codes
                    got = encode(matrix(batch.column("y").take(pa.array(own)))) if dim else (np.zeros((len(own), 0), np.uint64), np.zeros((len(own), LEVELS)), np.zeros((len(own), LEVELS + 1)))
                for to, x in zip((code, along, left), got, strict=True):
                    for i, v in zip(own.tolist(), x, strict=True):
                        to[i] = v.tobytes() if x.dtype == np.uint64 else v
            made = [pa.array(code, pa.binary()), pa.array(along, pa.list_(pa.float64())), pa.array(left, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "code", "along", "left"])

    return rows.mapInArrow(run, schema_of(rows, "code binary, along array<double>, left array<double>"))


class Asked:
    """Queries of one length: rounded rotations at every level, as bit planes."""

    def __init__(self, y: np.ndarray):
        self.y, self.norm = y, np.linalg.norm(y, axis=1)
        self.levels, dim, z = [], y.shape[1], y
        for level in range(LEVELS if dim else 0):
            z = z @ rotation(level, dim)
            low, high = z.min(axis=1), z.max(axis=1)
            step = np.maximum(high - low, 1e-300) / ((1 << BITS) - 1)
            whole = np.rint((z - low[:, None]) / step[:, None])
            near = low[:, None] + step[:, None] * whole
            bits = whole.astype(np.int64)
            planes = np.stack([packed((bits >> b) & 1 > 0) for b in range(BITS)], axis=1)
            self.levels.append((planes, low, step, near.sum(axis=1), np.linalg.norm(z - near, axis=1)))

    def along_codes(self, n: int, level: int, words: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, float]:
        """Inner products of query ``n`` with code vectors (word by row), and how far they may be off."""
        planes, low, step, total, off = self.levels[level]
        dim = self.y.shape[1]
        counts = np.zeros(words.shape[1], np.uint16 if dim << BITS < 1 << 16 else np.uint32)
        for b, plane in enumerate(planes[n]):
            for word, mask in zip(words, plane, strict=True):
                counts += np.bitwise_count(word & mask) * counts.dtype.type(1 << b)
        scale = 2 / math.sqrt(dim)
        return counts * (scale * step[n]) + (ones * (scale * low[n]) - total[n] / math.sqrt(dim)), off[n]


class Seen:
    """A batch of rows of one length: codes, alignments and norms, level by level."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids, self.y = batch.column("id").to_numpy(), matrix(batch.column("y"))
        self.along = np.ascontiguousarray(matrix(batch.column("along")).T)
        self.left = np.ascontiguousarray(matrix(batch.column("left")).T)
        words = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint64).reshape(len(self.ids), LEVELS, -1)
        self.words = np.ascontiguousarray(words.transpose(1, 2, 0))
        self.ones = np.bitwise_count(self.words).sum(axis=1, dtype=np.float64)


class Mine:
    """One block of queries against the batches of a group of rows: the ``k`` best rows of each band.

    ``same``: rows of the query's label, else rows of the other labels.
    """

    def __init__(self, k: int, same: bool):
        self.same, self.queries, self.held = same, [], Best(k)

    def ask(self, batch: pa.RecordBatch) -> None:
        none = [(-math.inf, math.inf)]
        bands = [[(b["low"], b["high"]) for b in bs] if bs is not None else none for bs in batch.column("bands").to_pylist()]
        with np.errstate(all="ignore"):  # numbers beyond doubles are scored without codes
            asked = Asked(matrix(batch.column("y")))
        columns = (batch.column(c).to_pylist() for c in ("id", "qkey", "label"))
        self.queries += [(i, key, label, asked, n, bands[n]) for n, (i, key, label) in enumerate(zip(*columns, strict=True))]

    def see(self, batch: pa.RecordBatch) -> None:
        if not self.queries:
            return
        rows = Seen(batch)
        labels = pc.dictionary_encode(batch.column("label"))
        number = {v: n for n, v in enumerate(labels.dictionary.to_pylist())}
        labels = labels.indices.to_numpy()
        for i, key, label, asked, n, bands in self.queries:
            own = labels == number.get(label, -1)
            some = (own if self.same else ~own) & (rows.ids != i)
            wide = ~(rows.left[0] * asked.norm[n] < EXACT)
            far = np.flatnonzero(some & wide)
            near = self.survivors(asked, n, bands, (i, key), some & ~wide, rows)
            scores = (rows.y[near] @ asked.y[n]).astype(np.int64)  # whole numbers, exact below EXACT
            if far.size:
                near, scores = np.append(near, far), np.append(scores, np.array(wide_scores(rows.y[far], asked.y[n]), np.int64))
            for b, (low, high) in enumerate(bands):
                wanted = (scores >= low) & (scores <= high)
                self.held.add((i, key, b), scores[wanted], rows.ids[near[wanted]])

    def survivors(self, asked: Asked, n: int, bands: list, at: tuple, some: np.ndarray, rows: Seen) -> np.ndarray:
        """Those of the rows (a mask) whose interval may hold a wanted score."""
        here = np.flatnonzero(some)
        if not asked.levels or not here.size or not bands:
            return here
        k, norm = self.held.k, asked.norm[n]
        floors = [max(low, self.held.floor((*at, b))) for b, (low, _) in enumerate(bands)]
        most = max(high for _, high in bands)
        whole = 2 * here.size > some.size  # most rows are asked for: work on all, pick afterwards
        pick = slice(None) if whole else here
        middle = off = 0.0
        for level in range(LEVELS):
            dot, slip = asked.along_codes(n, level, rows.words[level][:, pick], rows.ones[level][pick])
            a = rows.along[level][pick]
            middle, off = middle + a * dot, off + a * slip
            if level == 0:
                continue  # a first code alone drops next to nothing
            half = off + norm * rows.left[level + 1][pick] + (1e-9 * norm * rows.left[0][pick] + 1e-6)
            lo, hi = middle - half, middle + half
            for b, (low, high) in enumerate(bands):
                if floors[b] == low:  # no list yet: the k-th of the scores that are sure
                    sure = lo[(lo >= low) & (hi <= high) & (some if whole else True)]
                    if len(sure) >= k:
                        floors[b] = max(low, float(np.partition(sure, len(sure) - k)[len(sure) - k]))
            keep = (hi >= min(floors)) & (lo <= most)
            if whole:
                keep &= some
                pick, whole = np.flatnonzero(keep), False
                middle, off = middle[pick], off[pick]
            else:
                pick, middle, off = pick[keep], middle[keep], off[keep]
            if not pick.size:
                break
        return pick if not isinstance(pick, slice) else here

    def found(self) -> pa.RecordBatch:
        return self.held.batch()


def hard_negatives(df: DataFrame, is_anchor, key: str = "vec_id", vector: str = "embedding", label: str = "label", n_positives: int = 5, n_negatives: int = 3, low_percent: int = 50, high_percent: int = 95, scale: float = SCALE) -> DataFrame:
    """For each row that ``is_anchor`` (a condition on ``id``) picks, and each of its positives, the first negatives.

    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.
    """
    rows = written(coded(scaled(vectors(df, key, vector, label), scale)), "codes")
    anchors = asked_once(rows.filter(is_anchor))
    bands = "array<struct<low:long,high:long>>"
    first = tiled(rows, anchors.withColumn("bands", F.lit(None).cast(bands)), lambda: Mine(n_positives, True))
    # low <= 100 * score / positive <= high in whole numbers; a band without whole numbers stays empty
    share = lambda percent: F.col("score").cast("decimal(20,0)") * F.lit(percent).cast("decimal(10,0)") / F.lit(100).cast("decimal(3,0)")
    low, high = F.ceil(share(low_percent)).cast("long"), F.floor(share(high_percent)).cast("long")
    positives = written(best(first, n_positives).select("id", "qkey", (F.col("rank") - 1).cast("int").alias("band"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"), low.alias("low"), high.alias("high")), "positives")
    wanted = positives.groupBy("id", "qkey").agg(F.array_sort(F.collect_list(F.struct("band", "low", "high"))).alias("b"))  # n_positives at most
    wanted = wanted.select("id", "qkey", F.transform("b", lambda x: F.struct(x["low"].alias("low"), x["high"].alias("high"))).alias("bands"))
    second = tiled(rows, anchors.join(wanted, ["id", "qkey"]), lambda: Mine(n_negatives, False))
    negatives = best(second, n_negatives).select("id", "qkey", "band", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    out = negatives.join(positives, ["id", "qkey", "band"])
    return out.select(F.col("id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("id") % 50 == 0)


__all__ = ["hard_negatives", "op11_negatives"]
