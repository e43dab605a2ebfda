"""Ranked lexical search with bag deduplication.

The vocabulary of the items is small next to that of the documents.  Each
document is read once: its terms are counted, and its bag, the (term, frequency)
pairs of the items' vocabulary, is kept.  Documents with the same bag and the same
length factor have the same score for every item, so they form a class: rows are
grouped by a hash of both and by the bag and the factor themselves, which verifies the
hash.  Classes are scored once, in 64-bit integers.  The ten best classes of an
item, ties by smallest member, hold its ten best documents: a class is scored
before another only if its smallest member ranks before all members of the other.
Only these classes are expanded to their first members by ascending id.

Items go in blocks whose vocabulary stays below ``BLOCK_BYTES``; a block's
vocabulary is broadcast, and each block is one pass over the documents, so any
number of items can be searched.

A null text has no terms.  An item without terms, or whose terms no document holds,
has no rows.  Rows of documents count as documents of their own, also if they repeat;
a null id ranks after all others of its score.  Items that repeat an id and a text
count once; an item with a null id is an item.  Empty tables give empty results.
Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalis.llm.common import add_columns, table, text_buffer, written

#: Bytes of the items' distinct terms, summed over the items, that one pass over the documents searches for.
BLOCK_BYTES = 32 << 20
#: (class, item) scores that a task holds at a time.
CELLS = 400_000

_INK = np.zeros(256, dtype=bool)
_INK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(arr: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms (digits, ASCII letters in lower case and all beyond ASCII) of all texts, and the first term of each text.

    Returns a binary array in order, and ``first`` with one entry more than there are texts.
    """
    data, off = text_buffer(arr)
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(off), np.int64)
    data = data + (((data >= 0x41) & (data <= 0x5A)) * np.uint8(0x20))
    ink = _INK[data]
    start = ink.copy()
    start[1:] &= ~ink[:-1]
    heads = off[:-1][off[:-1] < len(data)]
    start[heads] = ink[heads]
    at = np.flatnonzero(start)
    before = np.concatenate([[0], np.cumsum(ink)])
    ends = np.append(before[at], before[-1]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[ink]))])
    return words, np.searchsorted(at, off).astype(np.int64)


def item_terms(items: DataFrame) -> DataFrame:
    """Append ``terms``, the distinct terms of each text, sorted."""

    def make():
        def f(batch: pa.RecordBatch) -> list[pa.Array]:
            words, first = terms(batch.column("text"))
            lists = [sorted(set(words[a:b].to_pylist())) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            return [pa.array(lists, pa.list_(pa.binary()))]

        return f

    return add_columns(items, "terms array<binary>", "text", make)


def bags(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Append ``n_terms`` and ``bag``, for each term of the vocabulary in the text: its number, its frequency, ...; by number."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)  # below BLOCK_BYTES

    def make():
        known = pa.array(held.value, pa.large_binary())

        def f(batch: pa.RecordBatch) -> list[pa.Array]:
            words, first = terms(batch.column("text"))
            coded = words.dictionary_encode()
            number = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy(zero_copy_only=False)
            term = number[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
            mine = term >= 0
            pair, count = np.unique(doc[mine] * np.int64(max(1, len(known))) + term[mine], return_counts=True)
            doc, term = np.divmod(pair, max(1, len(known)))
            flat = np.stack([term, count], axis=1).astype(np.int32).ravel()
            ends = 2 * np.searchsorted(doc, np.arange(batch.num_rows + 1))
            return [pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]

        return f

    return add_columns(docs, "n_terms long, bag array<int>", "text", make)


def class_scores(classes: DataFrame, postings: list[tuple[int, list[int]]], n_items: int, weights: dict[int, int], k: int) -> DataFrame:
    """The ``k`` best classes of each item, by rows that each task keeps: ``item``, ``score`` and the class.

    ``postings``: items of each term.
    """
    held = classes.sparkSession.sparkContext.broadcast((postings, weights))  # items of one block
    size = max(p for p, _ in postings) + 1 if postings else 0
    names = ["h1", "h2", "m", "first_id"]

    def run(batches):
        lists, weight_of = held.value
        weight, count = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for t, w in weight_of.items():
            weight[t] = w
        for t, own in lists:
            count[t] = len(own)
        start = np.concatenate([[0], np.cumsum(count)])
        flat = np.concatenate([np.array(own, np.int64) for _, own in sorted(lists)]) if lists else np.zeros(0, np.int64)
        kept = None  # per item: the best so far, as rows (item, score, first_id, ...)
        step = max(1, CELLS // max(1, n_items))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ends = np.concatenate([[0], np.cumsum(part.column("bag").value_lengths().to_numpy() // 2)])
                pairs = part.column("bag").flatten().to_numpy().reshape(-1, 2).astype(np.int64)
                row = np.repeat(np.arange(part.num_rows), np.diff(ends))
                term, tf = pairs[:, 0], pairs[:, 1]
                m = part.column("m").to_numpy()[row]
                gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                n = count[term]
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                cell = np.repeat(row * n_items, n) + flat[np.repeat(start[term], n) + within]
                score = np.zeros(part.num_rows * n_items, np.int64)
                np.add.at(score, cell, np.repeat(gain, n))
                some = np.flatnonzero(score)
                cols = [part.column(c).to_numpy(zero_copy_only=False) for c in names[:3]]
                ids = part.column("first_id")
                null = pc.is_null(ids).to_numpy(zero_copy_only=False)
                cols += [ids.fill_null(0).to_numpy(), null]
                r, item = np.divmod(some, n_items)
                new = [item, score[some], *[c[r] for c in cols]]
                if kept is not None:
                    new = [np.concatenate(x) for x in zip(kept, new, strict=True)]
                order = np.lexsort((new[5], new[6], -new[1], new[0]))
                item = new[0][order]
                place = np.arange(len(item)) - np.searchsorted(item, item)
                kept = [x[order[place < k]] for x in new]
        if kept is not None and len(kept[0]):
            ids = pa.array(kept[5], pa.int64(), mask=kept[6].astype(bool))
            yield pa.RecordBatch.from_arrays([pa.array(kept[0].astype(np.int32)), pa.array(kept[1]), pa.array(kept[2]), pa.array(kept[3]), pa.array(kept[4]), ids], names=["item", "score", *names])

    return classes.select(*names, "bag").mapInArrow(run, "item int, score long, h1 long, h2 long, m long, first_id long")


def weight(n_docs: int, df: Column) -> Column:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))."""
    return F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2)) / (F.lit(2.0) * df + F.lit(1.0)))).cast("long")


def _block(docs: DataFrame, block: list, k: int) -> DataFrame:
    """Ranks of the items of one block: ``item`` (its place in the block), ``rank``, ``id`` and ``score``."""
    vocabulary = sorted({t for r in block for t in r["terms"]})
    number = {t: n for n, t in enumerate(vocabulary)}
    postings: dict[int, list[int]] = {}
    for i, r in enumerate(block):
        for t in r["terms"]:
            postings.setdefault(number[t], []).append(i)
    read = written(bags(docs, vocabulary).select("id", "n_terms", "bag"), "bags")
    n_docs, n_all = read.agg(F.count(F.when(F.col("n_terms") > 0, 1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    m = F.lit(100 - 90) + F.expr(f"CAST(90 AS BIGINT) * n_terms * {n_docs}L div {max(1, n_all)}L")
    keyed = read.filter(F.size("bag") > 0).withColumn("m", m).withColumns({"h1": F.xxhash64(F.lit(1), "m", "bag"), "h2": F.xxhash64(F.lit(2), "m", "bag")})
    classes = written(keyed.groupBy("h1", "h2", "m", "bag").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "classes")
    held = classes.select("copies", F.explode(F.filter("bag", lambda x, i: i % 2 == 0)).alias("term")).groupBy("term").agg(F.sum("copies").alias("df"))
    weights = {r["term"]: r["w"] for r in held.select("term", weight(n_docs, F.col("df")).alias("w")).collect()}  # one block's vocabulary at most
    scored = class_scores(classes, sorted(postings.items()), len(block), weights, k)
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first_id"))
    chosen = scored.withColumn("__place", F.row_number().over(place)).filter(F.col("__place") <= k).drop("__place")
    chosen = written(chosen, "chosen")
    wanted = written(chosen.select("h1", "h2", "m").distinct(), "wanted")
    near = keyed.alias("d").join(wanted.alias("w"), _same_class("d", "w")).select("d.id", "d.h1", "d.h2", "d.m", "d.bag")
    first = Window.partitionBy("h1", "h2", "m", "bag").orderBy(F.asc_nulls_last("id"))
    near = near.withColumn("__n", F.row_number().over(first)).filter(F.col("__n") <= k)
    # members are matched by the bag itself, not by hashes alone
    exact = classes.alias("c").join(chosen.select("h1", "h2", "m", "first_id").distinct().alias("w"), _same_class("c", "w") & F.col("c.first_id").eqNullSafe(F.col("w.first_id"))).select("c.h1", "c.h2", "c.m", "c.bag", "c.first_id")
    members = near.alias("d").join(exact.alias("x"), _same_class("d", "x") & (F.col("d.bag") == F.col("x.bag"))).select("d.id", "x.h1", "x.h2", "x.m", "x.first_id")
    both = chosen.alias("s").join(members.alias("d"), _same_class("s", "d") & F.col("s.first_id").eqNullSafe(F.col("d.first_id")))
    last = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return both.select("s.item", "s.score", "d.id").withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)


def _same_class(a: str, b: str) -> Column:
    return (F.col(f"{a}.h1") == F.col(f"{b}.h1")) & (F.col(f"{a}.h2") == F.col(f"{b}.h2")) & (F.col(f"{a}.m") == F.col(f"{b}.m"))


def ranked(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: ``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``."""
    docs = docs.select(F.col(f"`{doc_key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    asked = items.select(F.col(f"`{item_key}`").alias("item_id"), F.col(f"`{text}`").cast("string").alias("text")).distinct()
    asked = written(item_terms(asked).drop("text").filter(F.size("terms") > 0), "items")
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 16)
    total = asked.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    of = F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks))
    out = None
    for b in range(blocks):
        block = asked.filter(of == b).orderBy("item_id", "terms").collect()  # about block_bytes
        if not block:
            continue
        names = docs.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        got = _block(docs, block, k).join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")
        out = got if out is None else out.union(got)
    if out is None:
        kind = asked.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


__all__ = ["op12_lexical", "ranked"]
