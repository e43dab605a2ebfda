"""Substring dedup: repeated passages found by a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words of a document; it is a repeat if its
word sequence also starts in a document with a smaller id.  All words covered
by repeats are removed.

Every window is anchored at its least hashed ``GRAM``-gram (a minimizer), so
equal windows have equal anchors.  The windows of a document that share an
anchor make one segment of at most 2 * WINDOW - GRAM words, and only small rows
(anchor, segment hash, id, place) are shuffled.  Anchors of one document alone
drop out.  Of equal segments the first document's copy stands for all: whatever
a later document has in it is a repeat.  Different segments with one anchor
meet in a shard: their words are indexed (BWT in a wavelet matrix), and all of
them are streamed through it by backward search.  The interval of each window
gives the smallest id that holds it; those below the segment's own id are
reported.  An anchor with more than ``HOT_WORDS`` words of different segments
is not put into one shard: its windows are grouped one by one by a 128-bit
hash, which pre-aggregates and gives the same result.

Nulls and empty texts have no words.  Rows with a null id neither remove nor
lose words.  Rows that repeat an id count as one document, so they do not remove
words from each other.  Texts shorter than a window stay whole.  Columns with
the names of the output columns are replaced; all others pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm.common import add_columns, gram_hashes, mix, slices, split_words, table, without, word_hashes, written
from vitalis.llm.fmindex import FMIndex

WINDOW, GRAM = 50, 10
#: Words that one shard indexes, about; and words of one anchor from which its windows go one by one.
SHARD_WORDS, HOT_WORDS = 400_000, 150_000


def sliding_least(x: np.ndarray, k: int) -> np.ndarray:
    """Least of each run of ``k`` values."""
    out, span, width = x, x, 1
    while width * 2 <= k:
        span = np.minimum(span[: len(span) - width], span[width:])
        width *= 2
    return np.minimum(span[: len(x) - k + 1], span[k - width : k - width + len(x) - k + 1]) if width < k else span


def segments(texts: pa.Array, window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Segments of all texts: text (row), at (first word), n (words), anchor and seg (hashes)."""
    words, first = split_words(texts)
    h = word_hashes(words)
    starts = len(h) - window + 1
    if starts < 1:
        return {k: np.zeros(0, np.int64) for k in ("text", "at", "n", "anchor", "seg")}
    grams, wide = gram_hashes(h, gram), gram_hashes(h, window, 0x8CB92BA72F3D8DD7)
    place = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << 26) - 1)
    least = sliding_least((mix(grams ^ np.uint64(0x5851F42D4C957F2D)) & ~low) | place, window - gram + 1)
    pos = (least & low).astype(np.int64)
    count = np.maximum(0, np.diff(first) - window + 1)  # windows of each text
    begin = np.repeat(first[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    text = np.repeat(np.arange(len(count)), count)
    at = pos[begin]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]) if len(at) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    a, b = begin[heads], begin[tails] if len(heads) else begin[:0]
    with np.errstate(over="ignore"):
        seg = mix(wide[a] * np.uint64(0xE7037ED1A0B428DB) + wide[b] * np.uint64(0xA0761D6478BD642F) + (b - a).astype(np.uint64) * np.uint64(0x589965CC75374CC3) + (at[heads] - a).astype(np.uint64))
    return {"text": text[heads], "at": a - first[text[heads]], "n": b - a + window, "anchor": grams[at[heads]].view(np.int64), "seg": seg.view(np.int64)}


def find_segments(docs: DataFrame) -> DataFrame:
    """Rows (anchor, seg, id, tag, at, n) of all documents (columns ``id``, ``tag``, ``text``)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                s = segments(part.column("text"))
                t = pa.array(s["text"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s["anchor"]), pa.array(s["seg"]), part.column("id").take(t), part.column("tag").take(t), pa.array(s["at"], pa.int32()), pa.array(s["n"], pa.int32())],
                    names=["anchor", "seg", "id", "tag", "at", "n"],
                )

    return docs.mapInArrow(run, "anchor long, seg long, id long, tag int, at int, n int")


def cut_out(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Words of wanted segments (anchor, seg, id, tag, at, n, hot): joined by spaces, or for hot anchors as window hashes."""
    lists = wanted.groupBy("id", "tag").agg(F.collect_list(F.struct("anchor", "seg", "at", "n", "hot")).alias("wanted"))  # as many as a document has
    told = docs.join(lists, ["id", "tag"]).select("id", "text", "wanted")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words, first = split_words(part.column("text"))
                out = {k: [] for k in ("anchor", "seg", "id", "words", "w1", "w2")}
                lists_, ids = part.column("wanted"), part.column("id").to_pylist()
                for i, row in enumerate(lists_.to_pylist()):
                    for w in row:
                        own = words.slice(first[i] + w["at"], w["n"])
                        out["anchor"].append(w["anchor"])
                        out["seg"].append(w["seg"])
                        out["id"].append(ids[i])
                        if w["hot"]:
                            h = word_hashes(own)
                            out["words"].append(None)
                            out["w1"].append(gram_hashes(h, WINDOW).view(np.int64).tolist())
                            out["w2"].append(gram_hashes(h, WINDOW, 0xC2B2AE3D27D4EB4F).view(np.int64).tolist())
                        else:
                            out["words"].append(b" ".join(own.to_pylist()).decode())
                            out["w1"].append(None)
                            out["w2"].append(None)
                yield pa.RecordBatch.from_pydict(out, schema=CUT)

    return told.mapInArrow(run, "anchor long, seg long, id long, words string, w1 array<long>, w2 array<long>")


CUT = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("id", pa.int64()), ("words", pa.string()), ("w1", pa.list_(pa.int64())), ("w2", pa.list_(pa.int64()))])


def search_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """Windows of a shard's segments that a smaller id holds: anchor, seg and ``offset`` of the window's first word."""
    words, first = split_words(pa.array(pdf["words"], pa.string()))
    coded = words.dictionary_encode()
    index = FMIndex(coded.indices.to_numpy().astype(np.int64), first, len(coded.dictionary), WINDOW)
    ids = pdf["id"].to_numpy()
    least = index.least(ids)
    who, where = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for texts, offsets, classes in index.search():
        hit = least[classes] < ids[texts]
        who.append(texts[hit])
        where.append(offsets[hit])
    who, where = np.concatenate(who), np.concatenate(where)
    return pd.DataFrame({"anchor": pdf["anchor"].to_numpy()[who], "seg": pdf["seg"].to_numpy()[who], "offset": where.astype(np.int32)})


def repeats(docs: DataFrame) -> DataFrame:
    """Word ranges [from, to) to remove: columns id, tag, from, to.  ``docs`` has id, tag and text."""
    found = written(find_segments(docs.filter("id IS NOT NULL")), "segments")
    shared = found.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("anchor")
    rows = written(found.join(shared, "anchor"), "shared")
    distinct = written(rows.groupBy("anchor", "seg").agg(F.min(F.struct("id", "tag", "at", "n")).alias("one")).select("anchor", "seg", "one.*"), "distinct")
    per = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("words")).filter("k > 1")
    wanted = distinct.join(per, "anchor").select(*distinct.columns, (F.col("words") > HOT_WORDS).alias("hot"))
    texts = written(cut_out(docs, wanted), "texts")
    cold = texts.filter("words IS NOT NULL")
    total = wanted.filter("NOT hot").agg(F.sum("n")).first()[0] or 0
    shard = F.pmod(F.xxhash64("anchor", F.lit(3)), F.lit(max(1, int(total // SHARD_WORDS)))).alias("shard")
    searched = cold.select("anchor", "seg", "id", "words", shard).groupBy("shard").applyInPandas(search_shard, "anchor long, seg long, offset int")
    windows = texts.filter("words IS NULL").select("anchor", "seg", "id", F.posexplode(F.arrays_zip("w1", "w2")).alias("offset", "w")).select("anchor", "seg", "id", "offset", "w.*")
    least = windows.groupBy("w1", "w2").agg(F.min("id").alias("low"))
    hot = windows.join(least, ["w1", "w2"]).filter("low < id").select("anchor", "seg", "offset")
    hits = searched.union(hot).groupBy("anchor", "seg").agg(F.collect_list("offset").alias("offsets"))  # at most WINDOW a segment
    marked = rows.join(distinct.select("anchor", "seg", F.col("id").alias("first_id")), ["anchor", "seg"]).join(written(hits, "hits"), ["anchor", "seg"], "left")
    whole = F.array(F.struct(F.col("at").alias("from"), (F.col("at") + F.col("n")).alias("to")))
    some = F.transform(F.coalesce("offsets", F.array().cast("array<int>")), lambda o: F.struct((F.col("at") + o).alias("from"), (F.col("at") + o + WINDOW).alias("to")))
    return marked.select("id", "tag", F.explode(F.when(F.col("id") > F.col("first_id"), whole).otherwise(some)).alias("r")).select("id", "tag", "r.*")


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", kept: str = "kept_text") -> DataFrame:
    """Append ``n_words``, ``n_removed`` and ``kept_text`` (the words that stay, joined by one space)."""
    rows = without(df, ["n_words", "n_removed", "__ranges", "__id", "__tag", *([kept] if kept != text else [])])
    tag = F.hash(F.col(f"`{text}`"))
    docs = rows.select(F.col(f"`{key}`").cast("long").alias("id"), tag.alias("tag"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    ranges = repeats(docs).groupBy("id", "tag").agg(F.collect_list(F.struct("from", "to")).alias("__ranges"))  # as many as a document has windows
    told = rows.select("*", F.col(f"`{key}`").cast("long").alias("__id"), tag.alias("__tag")).join(ranges.withColumnsRenamed({"id": "__id", "tag": "__tag"}), ["__id", "__tag"], "left").drop("__id", "__tag")

    def make():
        def f(batch):
            words, first = split_words(batch.column(text))
            gone = np.zeros(len(words) + 1, np.int64)
            ranges_ = batch.column("__ranges")
            flat = ranges_.flatten()
            count = ranges_.value_lengths().fill_null(0).to_numpy()
            base = np.repeat(first[:-1], count)
            np.add.at(gone, base + flat.field("from").to_numpy(), 1)
            np.add.at(gone, base + flat.field("to").to_numpy(), -1)
            stays = np.cumsum(gone[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(stays)])[first]
            chosen = words.filter(pa.array(stays)).to_pylist() if len(words) else []
            texts = [b" ".join(chosen[a:b]).decode() for a, b in zip(left[:-1], left[1:], strict=True)]
            n = np.diff(first)
            return pa.array(n), pa.array(n - np.diff(left)), pa.array(texts, pa.string())

        return f

    return add_columns(told, "n_words long, n_removed long, __kept string", text, make).drop("__ranges", *([text] if kept == text else [])).withColumnRenamed("__kept", kept)


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
