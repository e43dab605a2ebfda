"""Quality rules with risk-controlled thresholds.

Base counts of each text are plain column expressions.  Four signals are made
of them; a rule rejects a document whose signal is above the rule's cutoff in
the document's stratum (its language).  The cutoffs come from labelled good
documents, all of them: for each stratum, rule and candidate cutoff, an exact binomial tail tells how likely it is to see so few
rejected good documents if the true rate of false rejection were the rule's
part of ``risk``.  The strictest cutoff whose tail is at most ``delta`` divided
by the number of tests (Bonferroni) is taken, so with probability 1 - delta all
rules together reject at most ``risk`` of the good documents of any stratum
that pass the base rule.  A rule without such
a cutoff, and every rule in a stratum without labels, rejects nothing there.

Nulls and empty texts have no words and fail the base rule.  A null stratum is
a stratum of its own.  A labelled id is one trial of a stratum, however many labels and
rows it has (its highest signal counts); every row is judged by itself.  Columns with
the names of the output columns are replaced.  Only DataFrame functions are
used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalis.llm.common import GAP, table, without, written

#: Signals and their candidate cutoffs, strictest first; a document above the cutoff is rejected.
CUTOFFS: dict[str, list[float]] = {
    "symbol_ratio": [0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3],
    "dup_line_ratio": [0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7],
    "repeat_ratio": [0.05, 0.1, 0.15, 0.2, 0.25],
    "word_length": [9.0, 10.0, 11.0, 12.0, 14.0, 18.0, 25.0],
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RISK, DELTA = 0.02, 0.05
WINDOW = 8
SYMBOLS = "#*$%&|<>"


def repeat_words(hashed: Column, k: int = WINDOW) -> Column:
    """Words inside windows of ``k`` words that occur twice or more, of an array of word hashes (a column)."""

    def windows(_: Column) -> Column:
        return F.transform(F.slice(hashed, 1, F.size(hashed) - (k - 1)), lambda x, i: F.xxhash64(x, *[F.get(hashed, i + j) for j in range(1, k)]))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = bound(ordered, lambda s: F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])))
        return bound(F.sort_array(F.transform(twice, lambda x: x["i"])), lambda p: F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(k), F.coalesce(F.get(p, j + 1) - x, F.lit(k)))), F.lit(0), lambda a, x: a + x))

    many = bound(windows(hashed), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))
    return F.when(F.size(hashed) <= k, F.lit(0)).otherwise(many).cast("long")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def base_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the base counts, ``n_lines`` (lines with a word) and ``base_failed``."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = without(df, [*BASE, "n_lines", "base_failed"])
    names = [F.col(f"`{c}`") for c in rows.columns]
    split = rows.select(*names, F.array_remove(F.split(t, GAP), "").alias("__words"), F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"))
    hashed = split.select("*", F.transform("__words", lambda x: F.xxhash64(x)).alias("__hashed"))
    counts = F.struct(
        F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        sum((F.octet_length(t) - F.octet_length(F.replace(t, F.lit(c), F.lit(""))) for c in SYMBOLS), F.lit(0)).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("__hashed")).alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
    )
    # explode of one element: filters on the counts aren't pushed below it, where they would count again
    counted = hashed.select(*names, F.explode(F.array(counts)).alias("__counts")).select(*names, "__counts.*")
    return counted.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def signals() -> dict[str, Column]:
    def ratio(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    return {
        "symbol_ratio": ratio("n_symbols", "word_chars"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": ratio("n_repeat_words", "n_words"),
        "word_length": ratio("word_chars", "n_words"),
    }


def tail(x: Column, n: Column, p: float) -> Column:
    """P(X <= x) of a binomial of ``n`` trials with chance ``p``, as a running log sum of its terms."""
    odds = math.log(p / (1 - p))
    zero = F.struct((n * math.log(1 - p)).cast("double").alias("term"), (n * math.log(1 - p)).cast("double").alias("total"))

    def add(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log((n - j + 1) / j) + odds
        high = F.greatest(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log(F.exp(acc["total"] - high) + F.exp(term - high))).alias("total"))

    steps = F.when(x > 0, F.sequence(F.lit(1), x.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, zero, add, lambda acc: F.exp(acc["total"]))


def cutoffs(counted: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Cutoff of each rule in each stratum: columns ``stratum`` and one for each signal (null: none)."""
    good = labels.filter("quality = 1").select(F.col(key).alias("__id")).distinct()
    passed = counted.filter(~F.col("base_failed")).select(F.col(key).alias("__id"), F.col(stratum).alias("stratum"), *[c.alias(s) for s, c in signals().items()])
    held = good.join(passed, "__id").groupBy("__id", "stratum").agg(*[F.max(c).alias(c) for c in signals()])
    above = [F.sum((F.col(s) > c).cast("long")).alias(f"{s}__{i}") for s, cs in CUTOFFS.items() for i, c in enumerate(cs)]
    counts = held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *above)
    tests = sum(map(len, CUTOFFS.values()))
    level = F.lit(delta / tests) / F.col("strata")
    part = risk / len(CUTOFFS)

    def chosen(s: str) -> Column:
        safe = [F.when((F.col(f"{s}__{i}") < F.col("n") * part) & (tail(F.col(f"{s}__{i}"), F.col("n"), part) <= level), F.lit(c)) for i, c in enumerate(CUTOFFS[s])]
        return F.coalesce(*safe).alias(s)

    return counts.withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy())).select("stratum", *[chosen(s) for s in CUTOFFS])


def verdict(counted: DataFrame, limits: DataFrame, stratum: str = "lang") -> DataFrame:
    """Append ``kept`` to rows with base counts: no base failure, and no signal above its cutoff.

    A stratum has a cutoff only if it has hundreds of labelled documents, so few rows of ``limits`` matter; Spark
    broadcasts them if the written table is small, and else splits the join's large strata.
    """
    some = limits.select(F.col("stratum").alias("__stratum"), *[F.col(s).alias(f"__{s}") for s in CUTOFFS]).filter(F.coalesce(*[F.col(f"__{s}") for s in CUTOFFS]).isNotNull())
    judged = counted.join(some, F.col(f"`{stratum}`").eqNullSafe(F.col("__stratum")), "left")
    rejected = F.lit(False)
    for s, c in signals().items():
        rejected = rejected | F.coalesce(c > F.col(f"__{s}"), F.lit(False))
    return judged.select(*[F.col(f"`{c}`") for c in without(counted, ["kept"]).columns], (~F.col("base_failed") & ~rejected).alias("kept"))


def learned(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Base counts of all rows without their texts, and the cutoffs, both written."""
    counted = written(base_counts(df.select(key, stratum, text), text).drop(text), "counts")
    return counted, written(cutoffs(counted, labels, key, stratum), "cutoffs")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted, limits = learned(table(spark, sf_dir, "documents", "doc_id", "lang", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))
    return verdict(counted, limits).select("doc_id", *BASE, "base_failed", "kept")
