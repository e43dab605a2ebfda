"""N-gram Jaccard join by MinHash banding.

Documents whose word sequences are equal form a class first; only one row a
class goes on.  Each class gets ``HASHES`` minima of seeded hashes over its
word 5-grams.  They are cut into bands, whose number and rows are chosen for
the target recall at the threshold; (band, hash) pairs are shuffled, and the
members of a bucket are tied to its smallest id.  The resulting candidate
groups are compared on their full n-gram sets, whole groups in one place.
A group beyond the memory bound is compared block by block, so no pair is lost
and no pair is ever a row: each place returns the links per document and
a spanning tree.

A text with 1 to 4 words has one n-gram, all its words.  Texts that are null,
empty or without words link with nothing.  Rows with a null id link with
nothing.  Rows that repeat id and text are one document, and each of them gets
its result; an id with several texts counts once for each of them.  Empty
tables give empty results.  Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm.common import add_columns, gram_hashes, split_words, table, word_hashes, written
from vitalis.llm.components import components, deal, roots_of

N, THRESHOLD, RECALL, HASHES = 5, 0.8, 0.999, 100
#: Words and documents that one place compares at a time.
PILE_WORDS, PILE_ROWS = 600_000, 3_000
#: Up to this many members an n-gram is counted pair by pair, above it by matrix products.
RARE = 48


def bands(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """Number of bands and rows of a band: the most rows that reach the recall at the threshold."""
    for rows in range(hashes, 0, -1):
        if 1 - (1 - threshold**rows) ** (hashes // rows) >= recall:
            return hashes // rows, rows
    raise ValueError("more hashes are needed for this recall")


def shingles(texts: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, and where each text's start (one entry more than texts)."""
    words, first = split_words(texts)
    h = word_hashes(words)
    all_grams = gram_hashes(h, n)
    count = np.diff(first)
    out = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    start = np.concatenate([[0], np.cumsum(out)])
    which = np.repeat(first[:-1] - start[:-1], out) + np.arange(start[-1])
    grams = np.zeros(start[-1], np.uint64)
    inside = np.repeat(count >= n, out)
    grams[inside] = all_grams[which[inside]]
    for i in np.flatnonzero((count > 0) & (count < n)):
        grams[start[i]] = gram_hashes(h[first[i] : first[i + 1]], int(count[i]), 0xA24BAED4963EE407)[0]
    return grams, start


def signature(n_bands: int, rows: int, n: int, text: str):
    """Function from texts to their class hashes, band hashes and number of words."""
    rng = np.random.default_rng(20_240_501)
    mult = rng.integers(0, 1 << 63, n_bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(0, 1 << 63, n_bands * rows, dtype=np.uint64)
    weigh = [rng.integers(0, 1 << 63, 2, dtype=np.uint64) | np.uint64(1) for _ in range(2)]

    def f(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(text)
        with np.errstate(over="ignore"):
            words, first = split_words(texts)
            h = word_hashes(words)
            count = np.diff(first)
            place = (np.arange(len(h)) - np.repeat(first[:-1], count)).astype(np.uint64)
            full = count > 0
            classes = []
            for a, b in weigh:  # sums of scrambled (word, place)
                x = h * a + place * b
                x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                x = (x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
                s = np.zeros(len(count), np.uint64)
                if len(h):
                    s[full] = np.add.reduceat(x ^ (x >> np.uint64(32)), first[:-1][full])
                classes.append(s.view(np.int64))
            grams, start = shingles(texts, n)
            out = np.zeros((len(count), n_bands), np.uint64)
            if len(grams):
                at = start[:-1][full]
                for band in range(n_bands):
                    acc = np.full(len(at), band + 1, np.uint64)
                    for r in range(band * rows, band * rows + rows):
                        low = np.minimum.reduceat(grams * mult[r] + plus[r], at)
                        acc = (acc ^ low) * np.uint64(0x9FB21C651E98DF25)
                        acc ^= acc >> np.uint64(28)
                    out[full, band] = acc
        keep = np.repeat(full, n_bands)
        listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full * n_bands)]), pa.int32()), pa.array(out.reshape(-1)[keep].view(np.int64)))
        return [pa.array(classes[0]), pa.array(classes[1]), listed, pa.array(count)]

    return f


def pair_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets (arrays of distinct hashes)."""
    m = len(sets)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    held = np.diff(np.append(start, len(values)))
    flat = np.zeros(m * m, np.int64)
    for d in np.unique(held[(held > 1) & (held <= RARE)]):
        members = rows[start[held == d][:, None] + np.arange(d)]
        a, b = np.triu_indices(d, 1)
        for at in range(0, len(members), max(1, 2_000_000 // len(a))):
            some = members[at : at + max(1, 2_000_000 // len(a))]
            flat += np.bincount((some[:, a] * m + some[:, b]).ravel(), minlength=m * m)
    both = flat.reshape(m, m)
    both = both + both.T
    common = np.flatnonzero(held > RARE)
    for at in range(0, len(common), 2048):
        some = common[at : at + 2048]
        matrix = np.zeros((m, len(some)), np.float32)
        matrix[rows[np.repeat(start[some], held[some]) + np.arange(held[some].sum()) - np.repeat(np.cumsum(held[some]) - held[some], held[some])], np.repeat(np.arange(len(some)), held[some])] = 1
        both += (matrix @ matrix.T).astype(np.int64)
    return both


def compare(pdf: pd.DataFrame, threshold: float, n: int) -> pd.DataFrame:
    """Links of the documents of one pile: id, links (copies counted) and root (smallest linked id of the pile)."""
    out = []
    pdf = pdf.drop_duplicates(["id", "side", "candidate", "text"])
    grams, start = shingles(pa.array(pdf["text"], pa.string()), n)
    sets = [np.unique(grams[a:b]) for a, b in zip(start[:-1], start[1:], strict=True)]
    ids, copies, side, group = pdf["id"].to_numpy(), pdf["copies"].to_numpy(), pdf["side"].to_numpy(), pdf["candidate"].to_numpy()
    order = np.lexsort((ids, group))
    for own in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        if len(own) > 1:
            size = np.array([len(sets[i]) for i in own])
            both = pair_counts([sets[i] for i in own])
            linked = both / np.maximum(1, size[:, None] + size[None, :] - both) >= threshold
            linked &= ids[own][:, None] != ids[own][None, :]
            part = side[own]
            linked &= (part[:, None] != part[None, :]) | (part == 0)[:, None]
            some = linked.any(axis=1)
            roots = roots_of(linked)
            out.append(pd.DataFrame({"id": ids[own], "links": linked @ copies[own], "root": ids[own][roots]})[some])
    return pd.concat(out) if out else pd.DataFrame({"id": [], "links": [], "root": []})


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL, n: int = N) -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, ``class_id`` (smallest id reachable by links), ``n_links``
    (other documents linked directly, copies included), ``copy_of`` (smallest id with the same words), ``kept``
    (is it the one of its class that stays?)."""
    n_bands, rows = bands(threshold, recall, HASHES)
    docs = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    signed = written(add_columns(docs, "c1 long, c2 long, bands array<long>, n_words long", "text", lambda: signature(n_bands, rows, n, "text")).drop("text"), "signatures")
    classes = signed.filter("id IS NOT NULL AND n_words > 0").groupBy("c1", "c2").agg(F.min("id").alias("rep"), F.countDistinct("id").alias("copies"), F.first("n_words").alias("n_words"), F.first("bands").alias("bands"))
    classes = written(classes, "classes")
    buckets = classes.select(F.col("rep").alias("a"), F.posexplode("bands").alias("band", "hash"))
    low = buckets.groupBy("band", "hash").agg(F.min("a").alias("b"), F.max("a").alias("high")).filter("b <> high").drop("high")
    candidates = components(buckets.join(low, ["band", "hash"]).select("a", "b")).withColumnRenamed("component", "candidate")
    reps = candidates.join(classes.select(F.col("rep").alias("id"), "copies", "n_words"), "id")
    told = deal(reps, "candidate", "n_words", PILE_WORDS, PILE_ROWS).join(docs, "id")
    compared = told.groupBy("pile").applyInPandas(lambda pdf: compare(pdf, threshold, n), "id long, links long, root long")
    links = written(compared, "links")
    joined = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    direct = links.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.select("c1", "c2", F.col("rep").alias("id"), "copies").join(direct, "id", "left").join(joined, "id", "left")
    known = known.select("c1", "c2", F.col("id").alias("copy_of"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("class_id"))
    lone = F.col("id").isNull() | (F.col("n_words") == 0)
    back = signed.withColumn("c1", F.when(~lone, F.col("c1"))).join(known, ["c1", "c2"], "left")
    return back.select(
        F.col("id").alias("doc_id"), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copy_of", "id").alias("copy_of"), (F.col("class_id").isNull() | (F.col("id") == F.col("class_id"))).alias("kept"),
    )


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
