"""Language identification by word-first backoff.

The model holds how often each word and each character n-gram (1 to 5, over
the word with its edges marked) occurs per language.  A known word scores by
its log frequency in each language; an unseen word falls back to its longest
n-grams that are known, then to shorter ones.  The scores of all words of a
text add up, and the language with the highest sum wins (ties: the first by
name); ``score`` is its softmax share.

The model is fitted on a bounded sample of labelled rows: different texts of
at most about ``SAMPLE_CHARS`` characters a language, picked by hash, and
keeps at most ``MOST_GRAMS`` words and n-grams of each length a language, those
that occur at least twice (single characters: once) in its sample.  The
prediction covers every whole text.

Nulls: a text that is null, empty or without a letter is ``und`` with score
0, and so is everything if there is nothing to learn from (empty tables).
Repeated rows are predicted alike.  Columns with the names of the output
columns are replaced.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalis.llm.common import add_columns, letters, split_words, table

#: Characters to learn from for each language, at most about so many.
SAMPLE_CHARS = 2_000_000
#: Entries of the model for each language and kind (words; n-grams of each length), at most so many.
MOST_GRAMS = 30_000
#: Numbers in the model, at most: with many languages each keeps fewer entries, so that the model can be broadcast.
MODEL_CELLS = 50_000_000
LENGTHS = (5, 4, 3, 2, 1)
#: Distinct tokens that a task keeps scored; beyond it the memo starts anew.
MEMO = 500_000


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Learn from rows with a text and a language; returns a model of bounded size."""
    spark = labelled.sparkSession
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    # different texts only: copies, however many, neither fill the sample nor crowd other texts out
    place = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 30))
    different = rows.groupBy("lang", F.xxhash64("text", F.lit(5)).alias("h")).agg(F.first(F.char_length("text")).alias("n"), F.first(place).alias("place"))
    sizes = {r["lang"]: r for r in different.groupBy("lang").agg(F.sum("n").alias("n"), F.min("place").alias("least")).collect() if r["n"]}  # a row a language
    if not sizes:
        return {"langs": [], "tables": {}, "totals": {}}
    most = max(1, min(MOST_GRAMS, MODEL_CELLS // ((len(LENGTHS) + 1) * len(sizes) ** 2)))
    # the texts with the smallest hashes: about SAMPLE_CHARS of each language, one text at least
    upto = {k: max(r["least"], int((1 << 30) * min(1.0, SAMPLE_CHARS / r["n"])) - 1) for k, r in sizes.items()}
    limit = F.element_at(F.create_map(*[F.lit(x) for k, n in upto.items() for x in (k, n)]), F.col("lang"))
    sample = rows.filter(place <= limit).dropDuplicates()  # copies share a hash

    def count(batches):
        for pdf in batches:
            out: dict[tuple[str, int, str], int] = {}
            for lang_, text_ in zip(pdf["lang"], pdf["text"], strict=True):
                for w in letters(text_):
                    out[lang_, 0, w] = out.get((lang_, 0, w), 0) + 1
            words = [(k, c) for k, c in out.items()]
            for (lang_, _, w), c in words:
                for n in LENGTHS:
                    for g in grams(w, n):
                        out[lang_, n, g] = out.get((lang_, n, g), 0) + c
            yield pd.DataFrame([(*k, c) for k, c in out.items()], columns=["lang", "kind", "gram", "n"])

    counts = sample.repartition(spark.sparkContext.defaultParallelism).mapInPandas(count, "lang string, kind int, gram string, n long").groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("total", F.sum("n").over(Window.partitionBy("lang", "kind"))).withColumn("rank", F.row_number().over(best)).filter((F.col("rank") <= most) & ((F.col("n") > 1) | (F.col("kind") == 1)))
    got = top.select("lang", "kind", "gram", "n", "total").toPandas()  # at most MOST_GRAMS rows a language and kind, and MODEL_CELLS numbers in all
    langs = sorted(sizes)
    at = {x: i for i, x in enumerate(langs)}
    tables: dict[int, dict[str, np.ndarray]] = {k: {} for k in (0, *LENGTHS)}
    totals = {k: np.ones(len(langs)) for k in (0, *LENGTHS)}
    for lang_, kind, gram, n, total in got.itertuples(index=False):
        tables[kind].setdefault(gram, np.zeros(len(langs), np.float32))[at[lang_]] = n
        totals[kind][at[lang_]] = total
    return {"langs": langs, "tables": tables, "totals": totals}


class Predictor:
    """Scores of words by a model, with a memo, for one task."""

    def __init__(self, model: dict):
        self.langs = model["langs"]
        self.rows = {k: {g: i for i, g in enumerate(t)} for k, t in model["tables"].items()}
        self.logs = {k: np.log(np.array([*t.values()]).reshape(-1, len(self.langs)) + 0.5) - np.log(model["totals"][k] + 0.5 * max(1, len(t))) for k, t in model["tables"].items()}
        self.forget()

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.known = np.zeros((0, len(self.langs) + 1))

    def words(self, words: list[str]) -> np.ndarray:
        """Scores of words: the word's own, or the mean over its longest known n-grams."""
        out = np.zeros((len(words), len(self.langs)))
        at = np.array([self.rows[0].get(w, -1) for w in words], np.int64)
        out[at >= 0] = self.logs[0][at[at >= 0]]
        left = np.flatnonzero(at < 0)
        for n in LENGTHS:
            rows = self.rows[n]
            found = [[r for g in grams(words[i], n) if (r := rows.get(g)) is not None] for i in left]
            count = np.array([len(f) for f in found], np.int64)
            some = count > 0
            if some.any():
                flat = self.logs[n][np.fromiter(itertools.chain.from_iterable(found), np.int64)]
                ends = np.cumsum(count[some])
                out[left[some]] = np.add.reduceat(flat, ends - count[some], axis=0) / count[some][:, None]
            left = left[~some]
        return out

    def learn(self, tokens: list[bytes]) -> None:
        """Add tokens to the memo: summed scores of their words, and the number of words."""
        parts = [letters(t.decode()) for t in tokens]
        flat = list(itertools.chain.from_iterable(parts))
        distinct = {w: i for i, w in enumerate(dict.fromkeys(flat))}
        scores = self.words(list(distinct))
        count = np.array([len(p) for p in parts], np.int64)
        new = np.zeros((len(tokens), len(self.langs) + 1))
        if flat:
            each = scores[np.array([distinct[w] for w in flat], np.int64)]
            new[count > 0, :-1] = np.add.reduceat(each, (np.cumsum(count) - count)[count > 0], axis=0)
        new[:, -1] = count
        self.memo.update(zip(tokens, range(len(self.known), len(self.known) + len(tokens)), strict=True))
        self.known = np.concatenate([self.known, new])

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        words, first = split_words(texts)
        n = len(first) - 1
        if not self.langs or not len(words):
            return pa.array(["und"] * n, pa.string()), pa.array(np.zeros(n))
        coded = words.dictionary_encode()
        tokens = coded.dictionary.to_pylist()
        if len(self.memo) + len(tokens) > MEMO:
            self.forget()
        self.learn([t for t in tokens if t not in self.memo])
        each = self.known[np.array([self.memo[t] for t in tokens], np.int64)][coded.indices.to_numpy()]
        sums = np.zeros((n, each.shape[1]))
        full = first[:-1] < first[1:]
        sums[full] = np.add.reduceat(each, first[:-1][full], axis=0)
        scores = sums[:, :-1]
        best = scores.argmax(axis=1)
        share = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
        none = sums[:, -1] == 0
        names = np.array([*self.langs, "und"], dtype=object)[np.where(none, len(self.langs), best)]
        return pa.array(names, pa.string()), pa.array(np.where(none, 0.0, share))


def predict(df: DataFrame, model: dict, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Append the predicted language of ``text`` and its share of belief."""
    held = df.sparkSession.sparkContext.broadcast(model)  # bounded by MODEL_CELLS

    def make():
        predictor = Predictor(held.value)
        return lambda batch: predictor(batch.column(text))

    return add_columns(df, f"`{lang_pred}` string, `{score}` double", text, make)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit(docs.filter(~held))
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
