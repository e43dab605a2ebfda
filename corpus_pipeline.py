"""Corpus pipeline: quality rules, near duplicates, repeated passages, source mix, BPE encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``; all but the last
return the columns of ``documents``.  Nulls, empty tables and repeated rows are
treated as the operators say; columns of the input that are named like an operator's own stay
as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.llm import bpe, jaccard, mixing, quality, substring
from vitalis.llm.common import GAP, table, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, with cutoffs learnt from the labels of ``docs``.

    The texts are counted once; what is rejected goes by the rows' numbers.  Columns named like the counts stay as they are.
    """
    rows = _numbered(docs)
    counted = written(quality.base_counts(rows.select("__row", "__doc.doc_id", "__doc.lang", "__doc.text")).drop("text"), "counted")
    limits = written(quality.cutoffs(counted, table(spark, sf_dir, "labels", "doc_id", "quality")), "cutoffs")
    gone = written(quality.verdict(counted, limits).filter("NOT kept").select("__row"), "rejected")
    return rows.join(gone, "__row", "left_anti").select("__doc.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id (null ids last).

    Ids that repeat or are null are judged like any other, by the rows' numbers; documents without words stay.
    """
    rows = _numbered(docs)
    told = jaccard.near_duplicates(rows.select("__row", F.col("__doc.text").alias("text")), key="__row")
    ids = rows.select("__row", F.col("__doc.doc_id").alias("__id"))
    judged = written(told.select(F.col("doc_id").alias("__row"), "class_id").join(ids, "__row"), "judged")
    first = judged.groupBy("class_id").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__row")).alias("first"))
    gone = judged.join(first, "class_id").filter(F.col("__row") != F.col("first.__row")).select("__row")
    return rows.join(written(gone, "gone"), "__row", "left_anti").select("__doc.*")


def _apart(docs: DataFrame, *names: str) -> DataFrame:
    """Rename columns that an operator would replace by its own."""
    return docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c.lower() in names})


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows as ``__doc`` with a number of their own, ``__row``: their place in ``docs``, which a written table gives alike each
    time it is read."""
    return docs.select(F.monotonically_increasing_id().alias("__row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that a smaller id has; texts without one stay as they are.

    What is left of a text is joined by single spaces; a document that loses every word goes.
    """
    mine, docs = docs.columns, _apart(docs, "n_words", "n_removed", "kept_text")
    cut = substring.remove_repeats(docs)
    left = cut.filter("n_removed = 0 OR n_removed < n_words").withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns).toDF(*mine)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a last, fractional repetition holds a text's first words."""
    mine, docs = docs.columns, _apart(docs, "source_size", "target", "taken")
    sized = docs.withColumn("__size", mixing.word_count(F.col("text")))
    taken = mixing.mix_sources(sized, size="__size").filter("taken > 0")
    copies = taken.withColumn("__left", F.explode(F.transform(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("__size")).cast("int") - 1), lambda i: F.col("taken") - i * F.col("__size"))))
    part = F.col("__left") < F.col("__size")
    first = F.array_join(F.slice(F.array_remove(F.split("text", GAP), ""), F.lit(1), F.col("__left").cast("int")), " ")
    cut = copies.withColumn("text", F.when(part, first).otherwise(F.col("text")))
    return cut.withColumn("n_chars", F.when(part, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns).toDF(*mine)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the text they decode to."""
    return bpe.digests(bpe.encode_decode(docs, bpe.public_vocabulary()), "doc_id", "lang", "source", "ids")


STAGES = [
    ("quality rules", good_documents),
    ("near duplicates", one_of_each),
    ("repeated passages", without_repeats),
    ("source mix", mixed),
    ("BPE encoding", encoded),
]

#: None: shingle hashes and the vocabulary's merges can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
