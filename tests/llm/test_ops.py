"""Operators of the training-data subpackage against brute force, and their edge cases."""

import base64
import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalis.llm import bpe, embed, fmindex, jaccard, langid, mixing, quality, sharding, substring, warc, wrappers
from vitalis.llm.common import table, written
from vitalis.session import scratch_path

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \t\n", "one", "two words", "ä ß  é x", "x " * 3000, "same text here again", "same text here again"]
DOCS = "doc_id long, text string, lang string, source string, size string, kept string"


def odd_docs(spark, texts=ODD):
    """Nulls in every column, repeated rows, and extra columns with names that operators use."""
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, "extra", "extra") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[-1], (None, "no id at all", None, None, None, None)], DOCS)


def words(text):
    return (text or "").encode().split()


# op1


def test_shards_are_gapless_and_grow_into_the_new_one_only(spark):
    got = sharding.op1_sharding(spark, SF).toPandas()
    docs = table(spark, SF, "documents").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    moved = got[got.shard != got.grown_shard]
    assert set(moved.grown_shard) == {40} and set(got.shard) <= set(range(40))
    import zlib

    texts = docs.set_index("doc_id").text
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 16 for r in got.itertuples())


def test_shards_of_odd_rows_and_of_none(spark):
    docs = odd_docs(spark).drop("size").withColumns({"size": F.lit(100), "text_crc32": F.crc32(F.col("text").cast("binary"))})
    for rows in (docs, docs.limit(0)):
        path = scratch_path(spark, "t")
        sharding.write_shards(rows, path, n_shards=4, bucket_bytes=150)
        got = sharding.read_shards(spark, path, rows).toPandas()
        assert len(got) == rows.count()
        for _, own in got.groupby("shard"):
            assert sorted(own.slot) == list(range(len(own)))


def test_rows_alike_fill_many_buckets(spark):
    """20,000 equal rows, and rows without an id: no bucket holds more than about twice its bound."""
    rows = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same text").alias("text")).union(spark.range(3_000).select(F.lit(None).cast("long"), F.concat(F.lit("t"), F.col("id").cast("string"))))
    sized = rows.withColumns({"size": F.lit(25).cast("long"), "text_crc32": F.crc32(F.col("text").cast("binary"))})
    path = scratch_path(spark, "t")
    sharding.write_shards(sized, path, n_shards=4, bucket_bytes=20_000)
    held = spark.read.parquet(path).groupBy("shard", "bucket").count().collect()
    assert sum(r["count"] for r in held) == 23_000 and len(held) >= 25 and max(r["count"] for r in held) <= 2 * 800
    got = sharding.read_shards(spark, path, sized)
    for _, own in got.toPandas().groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_shard_is_the_highest_weight(spark):
    """Shard and grown shard, found again from the weights of all shards as rows."""
    got = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.op1_sharding(spark, SF).collect()}
    weights = spark.createDataFrame([(i,) for i in got], "id long").crossJoin(spark.range(41).select(F.col("id").cast("int").alias("s"))).select("id", "s", F.xxhash64(F.lit(sharding.SEED), "id", "s").alias("w")).collect()
    best, grown = {}, {}
    for r in weights:
        grown[r.id] = max(grown.get(r.id, (-(2**63), -1)), (r.w, r.s))
        if r.s < 40:
            best[r.id] = max(best.get(r.id, (-(2**63), -1)), (r.w, r.s))
    assert got == {i: (best[i][1], grown[i][1]) for i in got}


def test_fisher_yates_changes_the_order(spark):
    got = sharding.op1_sharding(spark, SF).toPandas().sort_values(["shard", "slot"])
    assert list(got.groupby("shard").doc_id.first()) != list(got.groupby("shard").doc_id.min())


# op2


def filled(sizes, weights, share, epochs):
    """Water-filling by the book: clamp and deal out again until nothing is above its limit."""
    left, open_ = share * sum(sizes), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_:
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / w >= epochs * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = epochs * sizes[i]
            open_.remove(i)
        left = share * sum(sizes) - sum(out)
    return out


def test_targets_are_the_fixpoint_of_water_filling(spark):
    rng = random.Random(3)
    for n in (1, 2, 5, 17):
        sizes = [rng.choice([0, 1, 10, 500, 10_000]) for _ in range(n)]
        df = spark.createDataFrame([(f"s{i:02}", s) for i, s in enumerate(sizes)], "source string, source_size long")
        got = [r.target for r in mixing.targets(df, [5, 2, 1], 1.5, 2.0).orderBy("source").collect()]
        assert got == pytest.approx(filled(sizes, [(5, 2, 1)[i % 3] for i in range(n)], 1.5, 2.0))


def test_mix_of_odd_rows(spark):
    docs = odd_docs(spark).withColumn("n", mixing.word_count(F.col("text")))
    got = mixing.mix_sources(docs, size="n").toPandas()
    assert len(got) == docs.count() and list(got.columns[:6]) == docs.columns[:6]
    assert (got.taken <= 2 * got.n).all() and (got.taken >= 0).all()
    by = got.assign(source=got.source.fillna("~")).groupby("source").agg(t=("taken", "sum"), g=("target", "first"))
    assert (abs(by.t - by.g) <= 1).all()
    assert mixing.mix_sources(docs.limit(0), size="n").count() == 0


# op3


def removed(docs):
    """Brute force: kept words and number of removed ones by row."""
    low = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            if i is not None:
                low[key] = min(low.get(key, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if i is not None and low[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def passages(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.choice([49, 50, 51, 80, 130]))] for _ in range(6)]
    docs = []
    for i in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
            if rng.random() < 0.7:
                w += rng.choice(shared)
        docs.append((rng.randint(0, 1000) * 100 + i, rng.choice([" ", "\n", "\t "]).join(w)))
    return [*docs, docs[3], (999_999, docs[4][1]), (None, docs[5][1]), (7_000_000, "a " * 300), (7_000_001, "a " * 120), (7_000_002, None), (7_000_003, "")]


@pytest.mark.parametrize("hot", [150_000, 100])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_WORDS", hot)
    monkeypatch.setattr(substring, "SHARD_WORDS", 2_000)
    docs = passages()
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in docs], "doc_id long, text string, seg string, n_removed int")
    got = substring.remove_repeats(df)
    assert got.columns == ["doc_id", "text", "seg", "n_words", "n_removed", "kept_text"]
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()], key=str) == removed(docs)


def test_substring_dedup_of_odd_rows_and_of_none(spark):
    docs = odd_docs(spark)
    assert substring.remove_repeats(docs).filter("n_removed > 0").count() == 0
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_index_finds_every_window(spark):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 3, rng.integers(1, 40)) for _ in range(30)]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    index = fmindex.FMIndex(np.concatenate(texts), first, 3, 5)
    ids = rng.permutation(30)
    least = index.least(ids)
    want = {}
    for j, t in enumerate(texts):
        for k in range(len(t) - 4):
            key = tuple(t[k : k + 5])
            want[key] = min(want.get(key, 99), ids[j])
    seen = 0
    for who, where, classes in index.search():
        for j, k, c in zip(who, where, classes):
            assert least[c] == want[tuple(texts[j][k : k + 5])]
            seen += 1
    assert seen == sum(max(0, len(t) - 4) for t in texts)


# op4


def test_encoding_equals_the_library(spark):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    parts = ["a", "b", "é", " ", "  ", "\n", "\t", " ", "　", "'s", "'S", "1", "٣", "!?", "<|endoftext|>", "日本", "é", "\x85", "\x1c", "ß", "😀", "'", " the", " \n", "\r\n", "\x00", "x" * 30, "à ", " ", "×", "''ll"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + [*ODD, "word " * 50_000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    tok = Tokenizer.from_file(bpe.public_vocabulary())
    got = bpe.encode_decode(df, bpe.public_vocabulary())
    assert got.columns == ["doc_id", "text", "ids", "decoded"] and got.limit(0).count() == 0
    for r in got.collect():
        want = tok.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == tok.decode(want, skip_special_tokens=False)


def test_encoding_digests(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.digests(bpe.encode_decode(df, bpe.public_vocabulary()), "doc_id").collect()}
    assert got[1].n_tokens == 2 and got[1].decoded_sha256 == hashlib.sha256(b"Hello world").hexdigest()
    assert got[1].ids_sha256 == hashlib.sha256(b"15496,995").hexdigest()
    assert got[2].n_tokens == 0 and got[2].ids_sha256 == got[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()


# op5


def test_language_on_held_out_documents(spark):
    got = langid.op5_language(spark, SF).join(table(spark, SF, "documents", "doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 200 and (held.lang == held.lang_pred).mean() > 0.95 and got.score.between(0, 1).all()


def test_language_of_odd_rows(spark):
    train = spark.createDataFrame([("the cat and the dog " * 3, "en"), ("der hund und die katze " * 3, "de"), (None, "de"), ("x", None)], "text string, lang string")
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 !!"), (4, "the dog"), (5, "der hund"), (6, "hun"), (7, "日本")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(docs, langid.fit(train)).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, 6)] == ["und", "und", "und", "en", "de", "de"]
    assert got[1].score == 0 and got[7].lang_pred == "de" and got[7].score == 0.5  # nothing known: the first by name
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(train.limit(0))).collect()} == {"und"}


def test_copies_do_not_crowd_texts_out(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 20_000)
    long = " ".join(f"immer{i} gleich" for i in range(8_000))
    rows = [(long, "de")] * 60 + [(f"kurzer satz nummer wort und das wort {i % 7}", "de") for i in range(40)] + [(f"a short sentence with the word and the {i}", "en") for i in range(40)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model["langs"] == ["de", "en"] and len(model["tables"][0]) > 3
    got = langid.predict(spark.createDataFrame([(t,) for t in ("das wort", "the word", "\u00bd \u00b2 \u2167", "7 ½", None)], "text string"), model).collect()
    assert [r.lang_pred for r in got] == ["de", "en", "und", "und", "und"] and [r.score for r in got][2:] == [0.0] * 3


def test_languages_of_odd_rows(spark):
    """Repeated rows, a very long text, and columns that are named like the results."""
    rows = [r for i in range(9) for r in ((f"der hund und die katze {i}", "de", "mine", 1), (f"the dog and the cat {i}", "en", "mine", 2))]
    df = spark.createDataFrame([*rows[:-1], rows[0], ("the cat " * 200_000, None, None, None)], "text string, lang string, lang_pred string, score int")
    got = langid.predict(df, langid.fit(df)).collect()
    assert len(got) == 19 and all(r.lang_pred == (r.lang or "en") and 0 <= r.score <= 1 for r in got)
    assert langid.predict(df.limit(0), langid.fit(df.limit(0))).count() == 0


# op6


def counts(text):
    w = words(text)
    runs = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    many = collections.Counter(runs)
    covered = {j for i, r in enumerate(runs) if many[r] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_base_counts_equal_brute_force(spark):
    texts = [r.text for r in table(spark, SF, "documents").collect()] + ODD + ["a b\n\na b\n \na b", "#1 $2 <x> é|é " * 9]
    got = quality.base_counts(odd_docs(spark, texts)).collect()
    for r in got:
        want = counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_binomial_tail_is_exact(spark):
    from math import comb

    df = spark.createDataFrame([(0, 10), (3, 50), (40, 2000), (0, 0)], "x long, n long")
    for r in df.select("x", "n", quality.tail(F.col("x"), F.col("n"), 0.02).alias("p")).collect():
        want = sum(comb(r.n, j) * 0.02**j * 0.98 ** (r.n - j) for j in range(r.x + 1))
        assert r.p == pytest.approx(want, rel=1e-9)


def test_cutoffs_limit_false_rejection(spark):
    n = 6000
    rows = [(i, "en", 100, 500, 500 * (i % 1000 == 0) + 1, 0, 10, 0, False) for i in range(n)] + [(n + i, "xx", 100, 500, 400, 0, 10, 0, False) for i in range(50)]
    counted = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long, base_failed boolean")
    labels = spark.createDataFrame([(i, 1) for i in range(n + 50)] + [(None, 1), (3, None)], "doc_id long, quality int")
    limits = quality.cutoffs(counted, labels)
    got = {r.stratum: r for r in limits.collect()}
    assert got["en"].symbol_ratio == quality.CUTOFFS["symbol_ratio"][0] and got["xx"].symbol_ratio is None
    judged = quality.verdict(counted, limits).toPandas()
    assert (~judged.kept).sum() == 6 and judged[judged.lang == "xx"].kept.all()
    assert quality.verdict(counted.limit(0), limits).count() == 0 and quality.verdict(counted, limits.limit(0)).filter("kept").count() == n + 50


def test_sql_of_the_counts_reads_odd_lines_alike(spark, tmp_path):
    """Lone CR, VT and FF are white space in lines, too; labels that repeat count once."""
    import duckdb

    from tests.test_registry import frame_hash
    from vitalis.llm.oracle import ORACLE

    texts = ["a\r\n\r\nb\r\n\r\nword\r\n", "x\n\x0b\n\x0c\n\r\nx\n \t\nx", "", None, " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i % 9}" for i in range(60))]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts * 5)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] * 3, "doc_id long, quality int")
    for name, df in (("documents", docs), ("labels", labels)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert frame_hash(quality.op6_quality(spark, str(tmp_path)).toPandas()) == frame_hash(con.execute(ORACLE["op6_quality"]).df())


def test_a_labelled_id_is_one_trial(spark):
    n = 3000
    row = lambda i, symbols: (i, "en", 100, 500, symbols, 0, 10, 0, False)
    columns = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long, base_failed boolean"
    counted = spark.createDataFrame([row(i, 1) for i in range(n)], columns)
    once = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    often = spark.createDataFrame([(i, 1) for i in range(200)] * 20, "doc_id long, quality int")
    assert quality.cutoffs(counted, once).collect() == quality.cutoffs(counted, often).collect() == quality.cutoffs(counted.union(counted), often).collect()


# op7


def test_archives_give_back_every_record(spark):
    rows = [(5, "u", "aa"), (3, None, "aa"), (None, "x", "aa"), (7, "y", None), (8, "z", ""), (9, "q", "WARC/1.0\r\n\r\nfoo\r\n\r\n"), (3, "r", "aa"), (1, "a\r\nb", "é" * 9000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")
    for pages, n in ((df, 8), (df.limit(0), 0)):
        path = scratch_path(spark, "t")
        warc.write_archives(pages, path, "page_id", "url", "html")
        records = warc.read_archives(spark, path)
        got = warc.resolved(records).collect()
        assert len(got) == n
        if n:
            blocks = {r.id: r.block for r in records.filter("record_type = 'response'").collect()}
            assert blocks == {3: "aa", 7: "", 9: rows[5][2], 1: rows[7][2]}
            assert sorted(str((r.id, r.record_type, r.refers_to, r.payload_bytes)) for r in got) == sorted(
                map(str, [(5, "revisit", 3, 2), (3, "response", None, 2), (3, "response", None, 2), (None, "revisit", 3, 2), (7, "response", None, 0), (8, "revisit", 7, 0), (9, "response", None, 19), (1, "response", None, 18000)])
            )


def test_long_pages_go_to_archives_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 13 << 20)
    long = spark.range(5).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.repeat(F.lit("0123456789"), 600_000), F.col("id").cast("string")).alias("html"))
    short = spark.range(5, 3_000).select(F.col("id"), F.lit("u"), F.concat(F.lit("page "), F.col("id").cast("string")))
    pages = long.union(short).union(long.limit(1).select(F.lit(9_999).cast("long"), "url", "html")).coalesce(1)
    path = scratch_path(spark, "t")
    warc.write_archives(pages, path, "page_id", "url", "html")
    records = warc.read_archives(spark, path)
    got = {r.id: r for r in warc.resolved(records).collect()}
    assert len(got) == 3_001 and all(got[i].payload_bytes == 6_000_001 for i in (0, 1, 2, 3, 4, 9_999)) and got[9_999].refers_to == 0
    held = [r.n for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select(F.length("content").alias("n")).collect()]
    assert len(held) >= 3 + 3 and max(held) < 1 << 20  # two long pages a file; digits compress well


def test_archives_of_the_pages(spark):
    pages = {r.page_id: r.html.encode() for r in table(spark, SF, "pages").collect()}
    got = warc.op7_warc(spark, SF).collect()
    assert {r.page_id: (r.payload_digest, r.payload_bytes) for r in got} == {i: (base64.b32encode(hashlib.sha1(h).digest()).decode(), len(h)) for i, h in pages.items()}


def test_short_payloads_are_responses(spark):
    df = spark.createDataFrame([(1, "ab", 1), (2, "ab", 1)], "id long, payload_digest string, payload_bytes long")
    assert [r.record_type for r in warc.resolve(df, "id", least=2).collect()] == ["response"] * 2


# op8


def jaccard_links(docs):
    def grams(t):
        w = words(t)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = {i: grams(t) for i, t in docs if i is not None}
    links = {a: {b for b in sets if b != a and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8} for a in sets}
    return links, reached(links)


def reached(links):
    component = {}
    for k in sorted(links):
        todo = [k]
        while todo:
            x = todo.pop()
            if x not in component:
                component[x] = k
                todo += links[x]
    return component


def near_copies(seed=2):
    rng = random.Random(seed)
    out = [(i, t) for i, t in enumerate(ODD)]
    for family in range(6):
        base = [f"v{rng.randint(0, 500)}" for _ in range(rng.choice([3, 30, 90]))]
        for k in range(12):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = f"n{rng.randint(0, 9)}"
            out.append((1000 * family + 100 + k, " ".join(w)))
    return [*out, out[-1], (None, out[-1][1])]


@pytest.mark.parametrize("pile", [600_000, 200])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, pile):
    monkeypatch.setattr(jaccard, "PILE_WORDS", pile)
    docs = near_copies()
    links, component = jaccard_links(docs)
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_links int")
    got = jaccard.near_duplicates(df).collect()
    assert len(got) == len(docs)
    for r in got:
        if r.doc_id is None:
            assert r.n_links == 0 and r.class_id is None and r.kept
        else:
            assert (r.n_links, r.class_id, r.kept) == (len(links[r.doc_id]), component[r.doc_id], component[r.doc_id] == r.doc_id)


def test_jaccard_join_of_none(spark):
    assert jaccard.near_duplicates(odd_docs(spark).limit(0)).count() == 0


def test_bands_reach_the_recall():
    n, rows = jaccard.bands(0.8, 0.999, 100)
    assert 1 - (1 - 0.8**rows) ** n >= 0.999 and n * rows <= 100


def test_pair_counts_both_ways(monkeypatch):
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    want = [[0 if i == j else len(np.intersect1d(a, b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    for rare in (0, 5, 100):
        monkeypatch.setattr(jaccard, "RARE", rare)
        got = jaccard.pair_counts(sets)
        np.fill_diagonal(got, 0)
        assert got.tolist() == want


# op9


@pytest.mark.parametrize(("leaf", "pile"), [(1500, 4000), (40, 60)])
def test_forest_finds_the_links(spark, monkeypatch, leaf, pile):
    monkeypatch.setattr(embed, "LEAF", leaf)
    monkeypatch.setattr(embed, "PILE_ROWS", pile)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 24))
    x[200:300] = x[rng.integers(0, 40, 100)] + 0.25 * rng.standard_normal((100, 24))
    x[300:320] = x[5]
    labels = [None if i % 50 == 49 else i % 3 for i in range(400)]
    rows = [(i * 3, v.tolist(), k) for i, (v, k) in enumerate(zip(x, labels))]
    odd = [(5000, None, 1), (5001, [0.0] * 24, 1), (5002, [float("nan")] * 24, 1), (5003, [None] * 24, 1), (5004, [], 1), (5005, [1.0, 2.0], 1), (5006, [2.0, 4.0], 1), (None, x[5].tolist(), labels[5])]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embed.near_duplicates(df).collect()}
    assert len(got) == len(rows) + len(odd)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    links = {3 * i: {3 * j for j in range(400) if j != i and near[i, j] and labels[i] is not None and labels[i] == labels[j]} for i in range(400)}
    found = sum(got[i].n_links for i in links)
    assert 0.9 <= found / sum(map(len, links.values())) <= 1 and all(got[i].n_links <= len(v) for i, v in links.items())
    if leaf == 1500:
        assert {i: got[i].component_id for i in links} == reached(links)
    assert [got[i].n_links for i in (5000, 5001, 5002, 5003, 5004)] == [0] * 5 and got[5005].n_links == got[5006].n_links == 1
    assert got[5006].component_id == 5005 and not got[5006].kept and got[5000].component_id == 5000
    assert embed.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("others", [0, 900])
def test_links_in_a_large_group_of_different_near_copies(spark, monkeypatch, others):
    monkeypatch.setattr(embed, "LEAF", 40)
    monkeypatch.setattr(embed, "PILE_ROWS", 300)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((900 + others, 32))
    x[:900] = x[0] / np.linalg.norm(x[0]) + 0.24 / np.sqrt(32) * rng.standard_normal((900, 32))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embed.near_duplicates(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    assert want[:900].min() > 100 and all(got[i] <= w for i, w in enumerate(want))
    assert sum(got.values()) >= 0.999 * want.sum()


# op10


PAGE = """<html><body><header>H</header><nav><ul><li><a>m1</a><li><a>m2</a></ul></nav><div class=cookie-notice>we use cookies</div>
<main><header><h1>T &amp; x</h1></header><p>One<b>two</b>
 three<p>Four<!-- c --> five&nbsp;six<aside>side</aside><form><input>f</form><div class="ad-slot">buy</div>
<table><tr><td>a<td>b</table><script>x</p></script><section id="comments"><p>nice</p></section></main><footer>F</footer>"""


def test_main_text_of_a_page():
    assert wrappers.extract(PAGE, wrappers.infer([wrappers.skeleton(PAGE)])) == "T & x\nOnetwo three\nFour five six\na\nb"


def test_wrapper_drops_the_template_of_a_host():
    def page(i, extra=""):
        return f"<body><div>Site name</div><div><a>Home</a></div><div><h2>title {i}</h2>{extra}<p>para {i} a</p><p>para {i} b</p></div><div>All rights</div></body>"

    wrapper = wrappers.infer([wrappers.skeleton(page(i, "<ul><li>x</ul>" * (i % 2))) for i in range(5)])
    assert wrappers.extract(page(9), wrapper) == "title 9\npara 9 a\npara 9 b"


def test_alignment_generalises():
    one = wrappers.skeleton("<div><p>a</p><p>b</p><p>c</p></div>")
    two = wrappers.skeleton("<div><h2>t</h2><p>d</p></div>")
    both = wrappers.align(one, two)
    kinds = [(n[0], n[1]) for n in both]
    assert ("(p # /p)+", False) in kinds and ("h2", True) in kinds and ("div", False) in kinds


def test_pages_of_the_table_and_odd_ones(spark):
    import html
    import re

    got = {r.page_id: r for r in wrappers.op10_html(spark, SF).collect()}
    pages = table(spark, SF, "pages").collect()
    for r in pages:
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", s)).split()) for s in re.split(r"</?(?:p|h1)>|<br>", body)]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text)
    odd = spark.createDataFrame([(1, None, None, "x"), (2, "", "", "x"), (3, "http://h/", "<p>a<p", "x"), (4, "nohost", "plain  text", "x"), (5, "http://h/2", "<!-- never closed <p>a", "x")], "page_id long, url string, html string, text string")
    assert [r.text for r in wrappers.extract_text(odd).orderBy("page_id").collect()] == ["", "", "a<p", "plain text", ""]
    assert wrappers.extract_text(odd.limit(0)).count() == 0


def test_template_is_counted_over_all_pages_of_a_host(spark):
    """A notice on 97% of 200 pages goes, also inside article; a passage on 90% stays, and so do near copies."""

    def page(i, open_, close):
        notice = "<div>All rights reserved</div>" if i % 33 else ""
        return f"<body>{open_}<p>para {i}</p>{'<p>often</p>' if i % 10 else ''}{notice}{close}</body>"

    shapes = {"a": ("<article>", "</article>"), "b": ("<div>", "</div>"), "c": ("<div class=with-header><article class=has-sidebar>", "</article></div>")}
    rows = [(f"http://{h}/{i}", page(i, *tags)) for h, tags in shapes.items() for i in range(200)]
    near = "".join(f"<p>same {k}</p>" for k in range(20))
    rows += [(f"http://n/{i}", f"<article>{near}<p>own {i}</p></article>") for i in range(8)]
    rows += [(f"http://three/{i}", f"<div><p>shared</p><p>own {i}</p></div>") for i in range(3)]
    rows += [(f"http://r/{i}", f"<article><p>own {i}</p></article><div class=comments><article class=comment><p>c{i}</p></article></div>") for i in range(9)]
    rows += [("http://b/copy", rows[201][1])] * 300  # copies count once
    got = {r.url: r.text for r in wrappers.extract_text(spark.createDataFrame(rows, "url string, html string")).collect()}
    for h in shapes:
        for i in range(200):
            assert got[f"http://{h}/{i}"] == f"para {i}" + ("\noften" if i % 10 else "")
    assert got["http://n/0"].count("same") == 20 and got["http://three/0"] == "shared\nown 0" and got["http://r/0"] == "own 0"


def by_host(page, n=8):
    """Texts of ``n`` pages of one host by its wrapper."""
    wrapper = wrappers.infer([wrappers.skeleton(page(i)) for i in range(n)])
    return [wrappers.extract(page(i), wrapper) for i in range(n)]


def test_the_wrapper_overrules_names():
    """A frame around all slots, a section with a doubtful name, and a heading that heads a slot hold main text."""
    framed = by_host(lambda i: f"<body><nav>menu</nav><div class='header-wrap with-sidebar'><div><h1>title {i}</h1><p>para {i}</p></div><div class=sidebar><p>ad {i}</p></div></div><div class=footer>foot</div></body>")
    assert framed == [f"title {i}\npara {i}" for i in range(8)]
    section = by_host(lambda i: f"<article><h1>t {i}</h1><p>a {i}</p><section class='discussion'><h2>d {i}</h2><p>b {i}</p><p>c {i}</p></section></article>")
    assert section == [f"t {i}\na {i}\nd {i}\nb {i}\nc {i}" for i in range(8)]
    posts = by_host(lambda i: f"<article><p>a {i}</p><div class='discussion'>" + "".join(f"<div><b>who {i}{k}</b><p>says {i}{k}</p></div>" for k in range(i % 3 + 2)) + "</div></article>")
    assert posts == [f"a {i}" for i in range(8)]
    headed = by_host(lambda i: f"<article><p>a {i}</p><h2>References</h2><ul><li>r {i}</li><li>s {i}</li></ul><h2>Newsletter</h2><p>Sign up</p></article>")
    assert headed == [f"a {i}\nReferences\nr {i}\ns {i}" for i in range(8)]
    comments = by_host(lambda i: f"<article><p>a {i}</p></article><div class=comments>" + "".join(f"<article class=comment><p>c {i} {k}</p></article>" for k in range(40)) + "</div>")
    assert comments == [f"a {i}" for i in range(8)]


def test_the_wrapper_of_the_tables_is_that_of_a_host(spark):
    """Frames and doubtful elements found by Spark, on a host and its near name."""
    def page(i):
        return f"<body><div class='banner-wrap'><div class='with-sidebar'><h1>t {i}</h1><p>p {i}</p><section class=discussion><p>d {i}</p></section></div></div><div class=related>r</div></body>"

    rows = [(f"http://x/{i}", page(i)) for i in range(12)] + [(f"http://y/{i}", page(i)) for i in range(2)]
    got = {r.url: r.text for r in wrappers.extract_text(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert [got[f"http://x/{i}"] for i in range(12)] == [f"t {i}\np {i}" for i in range(12)]  # the doubtful section is in no main element: its name counts
    assert got["http://y/0"] == ""  # too few pages: the names decide


def test_lists_are_told_by_all_pages_of_a_host(spark):
    """One page of 120 repeats the posts of the section, a page too long for a sample or one of a form of its own; a single post is then one, too."""
    def page(i, posts, more=""):
        posts = "".join(f"<div><b>who {i} {k}</b><p>says {i} {k}</p></div>" for k in range(posts))
        return f"<article><p>a {i}</p>{'<p>x</p><h3>y</h3>' * (i % 40)}{more}<section class=discussion>{posts}</section></article>"

    def pages(host, one, posts=0):
        return [(f"http://{host}/{i}", one if i == 77 else page(i, posts)) for i in range(120)]

    long = "".join(f"<h{k % 6 + 1}>w {k}</h{k % 6 + 1}>" * 2 for k in range(1, 900))
    rows = pages("long", page(77, 3, long), 1) + pages("rare", page(77, 2, "<h5>z</h5><table><tr><td>q</table>"), 1) + pages("none", page(77, 1), 1)
    got = {r.url: r.text for r in wrappers.extract_text(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert len(got) == 360
    assert [u for u, t in got.items() if ("who" in t or "says" in t) != u.startswith("http://none/")] == []
    for host in ("long", "rare", "none"):
        some = [p for u, p in rows if u.startswith(f"http://{host}/")]
        wrapper = wrappers.infer([wrappers.skeleton(p) for p in some])
        assert [wrappers.extract(p, wrapper) for p in some] == [got[u] for u, _ in rows if u.startswith(f"http://{host}/")]


def test_malformed_pages_take_linear_time():
    import time

    pages = ["<a href='" * 110_000, "<a href='" * 110_001 + ">x", "<div>x" * 100_000, "<a " * 300_000 + "<!x", "<a '>' " * 140_000 + "'", "<form><li>" * 50_000, "<div>" * 50_000 + "</p></li>" * 50_000, "<!--" * 200_000, "<script>" * 100_000, "<" * 1_000_000]
    for p in pages:
        start = time.perf_counter()
        wrappers.extract(p, wrappers.NONE)
        assert time.perf_counter() - start < 5, p[:20]
    assert wrappers.extract("<p>a</p><a title=\"x > y\">b</a><p title='>c</p>d", wrappers.NONE) == "a\nb\nc\nd"


def test_host_of_an_url(spark):
    urls = ["http://A.example.org/x", "https://u:p@b.example.org:80?q", "//c.example.org#f", "d/e", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r.h for r in df.select(wrappers.host_of(F.col("u")).alias("h")).collect()] == ["a.example.org", "b.example.org", "c.example.org", "", ""]


def test_written_tables_are_in_the_shared_folder(spark):
    df = written(spark.range(3).toDF("x"), "t")
    assert df.count() == 3 and all(spark.conf.get("spark.checkpoint.dir").removeprefix("file:") in f for f in df.inputFiles())
