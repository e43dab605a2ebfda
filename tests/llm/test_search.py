"""Hard negatives, ranked lexical search and exact top-k against brute force, and their edge cases."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalis.llm import lexical, negatives, tiles, topk

ROWS = "vec_id long, embedding array<double>, label string, score string, y string"


def vector_rows(seed=1, n=260, dim=11):
    """Random, equal, scaled and tied vectors; nulls in every column, odd components, other lengths, repeated rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(0, 1) for _ in range(dim)]
        if i % 9 == 0:
            v = [0.5] * dim
        elif i % 13 == 0:
            v = [float(round(x)) for x in v]
        rows.append((i - 20, v, f"l{rng.choice([0, 0, 0, 1, 2])}", "extra", None))
    odd = [None, [], [], [math.nan] * dim, [math.inf] + [0.0] * (dim - 1), [None] * dim, [1.0, 2.0], [3.0, 1.0], [0.0] * dim, [1e12] * dim, [-1e12] * dim, [1e200] * dim]
    rows += [(10_000 + i, v, "l0" if i % 2 else "l1", None, "extra") for i, v in enumerate(odd)]
    rows += [(None, [0.1] * dim, "l0", None, None), (20_000, [0.2] * dim, None, None, None), rows[40], rows[20], rows[20], (0, [0.25] * dim, "l1", None, None)]
    return rows


def whole(rows):
    """Rows that take part: (id, whole numbers, label)."""
    out = []
    for i, v, label, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, tuple(int(x) for x in np.nan_to_num(np.floor(256 * np.array(v, float)))), label))
    return out


def dot(a, b):
    return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=True))))


def by_hand(rows, k):
    out = []
    for i, q in sorted({(i, q) for i, q, _ in whole(rows) if i % 50 == 0}):
        found = sorted((-dot(q, y), j) for j, y, _ in whole(rows) if j != i and len(y) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(8192, 8192), (3, 40)])
def test_top_k_is_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(tiles, "QUERIES", sizes[0])
    monkeypatch.setattr(tiles, "ROWS", sizes[1])
    rows = vector_rows()
    df = spark.createDataFrame(rows, ROWS)
    for k in (1, 5):
        assert sorted(map(tuple, topk.top_k(df, F.col("id") % 50 == 0, k).collect())) == by_hand(rows, k)
    assert topk.top_k(df.limit(0), F.col("id") % 50 == 0).count() == 0


def test_bounds_drop_candidates_and_keep_the_best():
    rng = np.random.default_rng(5)
    near = rng.standard_normal(64)
    y = np.floor(256 * np.concatenate([rng.standard_normal((5000, 64)), near + 0.1 * rng.standard_normal((20, 64))]))
    q = np.floor(256 * near)
    mass = np.stack([(y.T[b : b + topk.BLOCK] ** 2).sum(axis=0) for b in range(0, 64, topk.BLOCK)])
    rows, scores = topk.bounded(np.ascontiguousarray(y.T), mass, q, 5, -math.inf)
    exact = (y @ q).astype(int)
    assert len(rows) < 100 and (scores == exact[rows]).all()
    assert sorted(scores)[-5:] == sorted(exact)[-5:]


@pytest.mark.parametrize("sizes", [(8192, 8192), (3, 40)])
def test_negatives_are_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(tiles, "QUERIES", sizes[0])
    monkeypatch.setattr(tiles, "ROWS", sizes[1])
    rows = vector_rows(2)
    got = negatives.hard_negatives(spark.createDataFrame(rows, ROWS), F.col("id") % 50 == 0)
    every = [r for r in whole(rows) if r[2] is not None]
    want = []
    for i, q, label in {r for r in every if r[0] % 50 == 0}:
        near = [(-dot(q, y), j, other) for j, y, other in every if j != i and len(y) == len(q)]
        for s, p, _ in sorted(x for x in near if x[2] == label)[:5]:
            found = sorted(x for x in near if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:3]
            want += [(i, p, n + 1, x[1], -s, -x[0]) for n, x in enumerate(found)]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 30
    assert negatives.hard_negatives(got.limit(0).select(F.col("anchor_id").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"), F.lit(1).alias("label")), F.col("id") % 50 == 0).count() == 0


def seen(y):
    """Rows as a task gets them."""
    import pyarrow as pa

    code, along, left = negatives.encode(y)
    cols = {"id": np.arange(len(y)), "y": list(y), "code": [c.tobytes() for c in code], "along": list(along), "left": list(left)}
    return negatives.Seen(pa.RecordBatch.from_arrays([pa.array(v) for v in cols.values()], names=[*cols]))


@pytest.mark.parametrize("dim", [1, 3, 64, 130])
def test_scores_lie_in_their_intervals_at_every_level(dim):
    rng = np.random.default_rng(dim)
    y = np.floor(256 * rng.standard_normal((400, dim)))
    asked, rows = negatives.Asked(np.floor(256 * rng.standard_normal((3, dim)))), seen(y)
    for n in range(3):
        exact, middle, off, widths = y @ asked.y[n], 0.0, 0.0, []
        for level in range(negatives.LEVELS):
            dots, slip = asked.along_codes(n, level, rows.words[level], rows.ones[level])
            middle, off = middle + rows.along[level] * dots, off + rows.along[level] * slip
            half = off + asked.norm[n] * rows.left[level + 1] + 1e-6
            assert (np.abs(exact - middle) <= half).all()
            widths.append(half.mean())
        assert widths == sorted(widths, reverse=True)


@pytest.mark.parametrize("part", [0.2, 0.9])
def test_intervals_drop_most_rows(part):
    rng = np.random.default_rng(3)
    y = np.floor(256 * (v := rng.standard_normal((20_000, 64))) / np.linalg.norm(v, axis=1, keepdims=True))
    kernel, exact, half = negatives.Mine(5, True), (y @ y[0]).astype(int), np.arange(1, 10_000)
    kernel.held.add((0, 0, 0), exact[half], half)  # what an earlier batch has found
    some = rng.random(10_000) < part
    rows = kernel.survivors(negatives.Asked(y[:1]), 0, [(-math.inf, math.inf)], (0, 0), some, seen(y[10_000:]))
    best = np.argsort(-exact[1:], kind="stable")[:5] + 1
    assert {b for b in best if b >= 10_000 and some[b - 10_000]} <= set(rows + 10_000) and some[rows].all() and len(rows) < 0.1 * some.sum()


# op12


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranked_by_hand(docs, items, k=10):
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    bags = [(i, b, b.total()) for i, b in bags if b]
    n_docs, n_all = len(bags), sum(n for *_, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in set(items):
        scores = []
        for i, b, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // n_all
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if b[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def lexical_docs(seed=4, n=150):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "ä", "Ä", "x1", "9", "ñu", "漢字", "zero", "one", "rare", "É", *[f"w{i}" for i in range(30)]]
    docs = [(i, rng.choice([" ", ", ", "\n", "-", "\x00", "·"]).join(rng.choices(vocabulary, k=rng.randint(1, 25)))) for i in range(n)]
    docs += [(1000 + i, "the one rare text w1 w2") for i in range(40)]  # one class, beyond ten members
    docs += [(500, "w1 the one rare w2 text"), (501, "THE ONE RARE TEXT W1 W2 w1"), (2000, None), (2001, ""), (2002, " -- ;"), (None, "the one rare text w1 w2"), (None, "no id zero"), docs[3], docs[3], (2003, "the one " * 40_000)]
    return docs


@pytest.mark.parametrize("block_bytes", [lexical.BLOCK_BYTES, 400])
def test_lexical_search_is_brute_force(spark, block_bytes):
    docs = lexical_docs()
    items = [(1, "the ONE rare"), (2, None), (3, ""), (4, "nothing of it"), (5, "Ä ñu 漢字 x1"), (6, "w1 w2 w3 w1 w1"), (None, "rare"), (1, "the ONE rare"), (7, "zero")]
    got = lexical.ranked(spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, score int, bag string"), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int"), block_bytes=block_bytes)
    want = ranked_by_hand(docs, items)
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) == 50


def test_lexical_search_of_none(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked(docs, items).count() == 0
    assert lexical.ranked(spark.createDataFrame([(1, "a")], docs.schema), items.limit(0)).count() == 0
    assert lexical.ranked(spark.createDataFrame([(1, None)], docs.schema), items).count() == 0
