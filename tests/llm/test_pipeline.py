"""Each stage of the corpus pipeline against a brute-force version on its own input."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tests.llm.test_ops import counts, jaccard_links, removed, words
from vitalis.llm import bpe, quality
from vitalis.llm.common import table, written
from vitalis.llm.mixing import mix_sources, word_count

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in C.STAGES:
        after = written(stage(spark, docs, SF), "stage")
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_columns_stay(stages):
    assert [s[3] for s in stages[:-1]] == [COLUMNS] * 4


def test_rejected_documents_go(stages, spark):
    _, before, after, _ = stages[0]
    failed = {r.doc_id for r in before if (c := counts(r.text))[0] < 20 or 100 * c[4] > 30 * c[0]}
    kept = {r.doc_id for r in after}
    assert not kept & failed and kept <= {r.doc_id for r in before}
    good = {r.doc_id for r in table(spark, SF, "labels").filter("quality = 1").collect()}
    clean = {r.doc_id for r in before if r.doc_id in good} - failed
    assert len(clean & kept) >= (1 - quality.RISK) * len(clean)


def test_one_of_each_group_stays(stages):
    _, before, after, _ = stages[1]
    _, component = jaccard_links([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == set(component.values())


def test_repeated_passages_go(stages):
    _, before, after, _ = stages[2]
    want = {i: t for i, n, gone, t in removed([(r.doc_id, r.text) for r in before]) if not gone or gone < n}
    assert {r.doc_id: " ".join(x.decode() for x in words(r.text)) for r in after} == want


def test_mix_repeats_documents(stages, spark):
    _, before, after, _ = stages[3]
    docs = spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")
    want = {r.doc_id: r.taken for r in mix_sources(docs.withColumn("size", word_count(docs.text))).collect() if r.taken}
    got = collections.Counter()
    for r in after:
        got[r.doc_id] += len(words(r.text))
    assert dict(got) == want


def test_encoding(stages):
    from tokenizers import Tokenizer

    _, before, after, _ = stages[4]
    tok = Tokenizer.from_file(bpe.public_vocabulary())
    want = sorted((r.doc_id, hashlib.sha256(",".join(map(str, tok.encode(r.text, add_special_tokens=False).ids)).encode()).hexdigest()) for r in before)
    assert sorted((r.doc_id, r.ids_sha256) for r in after) == want


def test_run_and_empty_documents(spark, stages):
    assert C.run(spark, SF).count() == len(stages[-1][2])
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def odd_documents(spark):
    """Nulls in every column, repeated rows and ids, empty and long texts, near copies, and columns with names that stages use."""
    base = [f"w{i}" for i in range(80)]
    near = " ".join([*base[:40], "x", *base[41:]])
    long = " ".join(f"v{i}" for i in range(30_000))
    clean = [" ".join(f"c{k}_{i}" for i in range(80)) for k in range(4)]
    rows = [
        (1, " ".join(base)), (2, near), (None, " ".join(base)), (None, near),  # one group
        (3, clean[0]), (3, near), (3, clean[0]),  # an id with two texts, and a row that repeats
        (4, None), (5, ""), (6, " \t"), (7, long), (8, long), (None, clean[1]), (None, clean[2]),
    ]
    full = [(i, t, "en" if n % 3 else None, f"s{n % 2}" if n % 4 else None, None if t is None else len(t), "mine", n, n, n) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int, n_removed int, class_id int")


def test_near_duplicates_are_judged_by_row(spark):
    docs = odd_documents(spark)
    after = C.one_of_each(spark, docs, SF)
    got = [r.asDict() for r in after.collect()]
    assert after.columns == docs.columns
    texts = [(r["doc_id"], r["text"]) for r in got]
    base, near, clean = docs.first().text, docs.collect()[1].text, [docs.collect()[k].text for k in (4, 12, 13)]
    assert [t for t in texts if t[1] in (base, near)] == [(1, base)]  # copies with null ids and with another text's id go
    assert sorted(t for t in texts if t[1] == clean[0]) == [(3, clean[0])]  # the clean text of that id stays, once
    assert {t[1] for t in texts} >= {*clean, None, "", " \t"} and sum(t[0] in (7, 8) for t in texts) == 1


def test_every_stage_takes_odd_rows(spark):
    docs = odd_documents(spark)
    before = {repr(r) for r in docs.collect()}
    for name, stage in C.STAGES[:2]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        assert {repr(r) for r in after.collect()} <= before, name  # clashing columns keep their values
    good = C.good_documents(spark, docs, SF).collect()
    assert {r.n_words for r in good} == {0, 1, 2, 3, 4, 5, 6, 10, 11, 12, 13} and all(r.kept == "mine" for r in good)
    named = docs.withColumns({c: F.col("n_words") for c in ("taken", "Target", "source_size", "kept_text")})
    for name, stage in C.STAGES[2:4]:
        after = stage(spark, named, SF)
        assert after.columns == named.columns, name
        assert all(r.n_words == r.n_removed == r.taken == r.Target == r.kept_text and r.kept == "mine" for r in after.collect()), name
    assert C.encoded(spark, named, SF).count() == docs.count()
    for name, stage in C.STAGES[2:]:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
