"""Embedding near-dedup by a forest of random-projection trees.

Equal vectors of a label form a class first; one row a class goes on.  Each
of ``TREES`` trees splits the vectors of a label again and again by their
projection on a random direction; vectors close to a split go to both sides
(spill), at least those within ``REACH`` of the distance that linked vectors
have on such a direction.  A split is put where it leaves the fewest pairs to
compare; a node that no split makes cheaper, such as a group whose vectors are
as close as links, stays a leaf of any size.  The splits are fitted on a bounded
sample, picked by a hash, and every vector is led down every tree.  The vectors of a leaf are
compared with each other, exactly, in double precision; a pair counts in the
first of its common leaves.  A leaf beyond the memory bound is compared block
by block, so no pair of a leaf is lost.  Each place returns the links per
vector and a spanning tree; pairs are never rows.

A vector that is null, empty, zero or holds a null or non-finite component, or
whose label is null, links with nothing; neither do vectors of different
length.  Rows with a null id link with nothing.  Rows that repeat an id and its
vector count as one.  Empty tables give empty results.  Other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis.llm.common import table, written
from vitalis.llm.components import components, deal

THRESHOLD = 0.93
#: Trees; vectors that a leaf should hold; part of the projections' spread that spills to each side.
TREES, LEAF, SPILL = 3, 400, 0.1
#: Least spill, as a part of what the distance of vectors at the threshold projects to (root mean square).
REACH = 0.5
#: Pairs left to compare after a split, as a part of those before, above which a node isn't split; levels of a tree.
WORTH, DEPTH = 0.9, 60
#: Shares of a node's vectors below the splits that are tried, the first of equal ones is taken.
SHARES = np.array([0.5, *(k / 20 for d in range(1, 9) for k in (10 - d, 10 + d))])
#: Vectors to fit the trees on, at most about so many; and sampled vectors from which a node is split.
SAMPLE, LEAST = 40_000, 32
#: Vectors that one place compares at a time.
PILE_ROWS = 8_000
#: Rows of a pile that are multiplied with all others at a time.
STRIP = 500
SEED = 20_240_501


def direction(tree: int, level: int, dim: int) -> np.ndarray:
    v = np.random.default_rng([SEED, tree, level, dim]).standard_normal(dim)
    return v / np.linalg.norm(v)


def fit(vectors: np.ndarray, leaf: float, trees: int = TREES, threshold: float = THRESHOLD) -> list[dict[int, tuple[float, float]]]:
    """Splits of each tree: node (root 1, children 2n and 2n + 1) -> (middle, spill width).

    ``leaf`` is the number of sampled vectors that stands for a full leaf.  If a tree has no
    splits, its one leaf holds all pairs, and it is the only tree.
    """
    reach = REACH * np.sqrt(max(0.0, 2 - 2 * threshold) / vectors.shape[1])
    forest = []
    for tree in range(trees):
        splits: dict[int, tuple[float, float]] = {}
        todo = [(1, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= max(leaf, LEAST) or node.bit_length() > DEPTH:
                continue
            p = vectors[rows] @ direction(tree, node.bit_length() - 1, vectors.shape[1])
            if p.max() - p.min() < 1e-6:
                continue  # copies of one vector: no split tells them apart
            wide = max(float(SPILL * p.std()), reach)
            ordered = np.sort(p)
            middles = np.quantile(ordered, SHARES)
            pairs = (np.searchsorted(ordered, middles + wide) / len(p)) ** 2 + (1 - np.searchsorted(ordered, middles - wide) / len(p)) ** 2
            if pairs.min() > WORTH:
                continue  # nearly all vectors are close to any split
            middle = float(middles[pairs.argmin()])
            left, right = rows[p < middle], rows[p >= middle]
            if len(left) and len(right):
                splits[node] = (middle, wide)
                todo += [(2 * node, left), (2 * node + 1, right)]
        if not splits:
            return [{}]
        forest.append(splits)
    return forest


def leaves(vectors: np.ndarray, forest: list[dict[int, tuple[float, float]]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each tree: (row, node) of every leaf that a vector reaches."""
    out = []
    for tree, splits in enumerate(forest):
        rows, nodes = np.arange(len(vectors)), np.ones(len(vectors), np.int64)
        done_rows, done_nodes, level = [], [], 0
        while len(rows):
            split = np.array([splits.get(n, (np.nan, 0.0)) for n in np.unique(nodes)]).reshape(-1, 2)[np.searchsorted(np.unique(nodes), nodes)]
            stop = np.isnan(split[:, 0])
            done_rows.append(rows[stop])
            done_nodes.append(nodes[stop])
            rows, nodes, split = rows[~stop], nodes[~stop], split[~stop]
            if len(rows):
                p = vectors[rows] @ direction(tree, level, vectors.shape[1])
                left, right = p < split[:, 0] + split[:, 1], p >= split[:, 0] - split[:, 1]
                rows, nodes = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * nodes[left], 2 * nodes[right] + 1])
            level += 1
        out.append((np.concatenate(done_rows) if done_rows else rows, np.concatenate(done_nodes) if done_nodes else nodes))
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def lead(reps: DataFrame, model: dict) -> DataFrame:
    """Append ``leaves``: sorted codes of the leaves that each vector reaches, over all trees."""
    held = reps.sparkSession.sparkContext.broadcast(model)  # splits of a bounded sample

    def code(label: int, dim: int, tree: int, nodes: np.ndarray) -> np.ndarray:
        from vitalis.llm.common import mix

        with np.errstate(over="ignore"):
            key = mix(np.uint64(label & (1 << 64) - 1) ^ mix(np.array([dim * 1009 + tree], np.uint64)))
            return mix(key ^ nodes.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)).view(np.int64)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, labels = batch.column("embedding"), batch.column("label").to_numpy()
            dims = vectors.value_lengths().to_numpy()
            found: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for label, dim in set(zip(labels.tolist(), dims.tolist(), strict=True)):
                own = np.flatnonzero((labels == label) & (dims == dim))
                x = unit(vectors.take(pa.array(own)).flatten().to_numpy().reshape(-1, dim))
                for tree, (rows, nodes) in enumerate(leaves(x, held.value.get((label, dim), [{}]))):
                    for r, c in zip(own[rows].tolist(), code(label, dim, tree, nodes).tolist(), strict=True):
                        found[r].append(c)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([sorted(f) for f in found], pa.list_(pa.int64()))], names=[*batch.schema.names, "leaves"])

    return reps.mapInArrow(run, T.StructType([*reps.schema.fields, T.StructField("leaves", T.ArrayType(T.LongType()))]))


def compare(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of the vectors of one pile: id, links (copies counted) and root (smallest linked id of the pile)."""
    out = []
    pdf = pdf.drop_duplicates(["id", "side", "leaf"])
    ids, copies, side, leaf = pdf["id"].to_numpy(), pdf["copies"].to_numpy(), pdf["side"].to_numpy(), pdf["leaf"].to_numpy()
    vectors, reached = pdf["embedding"].to_numpy(), pdf["leaves"].to_numpy()
    order = np.lexsort((ids, leaf))
    for own in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
        if len(own) < 2:
            continue
        raw = np.stack(vectors[own]).astype(np.float64)
        x, part, weight = unit(raw), side[own], copies[own]
        earlier = [[c for c in reached[i] if c < leaf[i]] for i in own]
        codes = {c: k for k, c in enumerate(sorted({c for e in earlier for c in e}))}
        member = np.zeros((len(own), len(codes)), np.float32)
        for k, e in enumerate(earlier):
            member[k, [codes[c] for c in e]] = 1
        # pairs of the vectors that have the most common of the smaller leaves are linked and counted there
        old = member[:, member.sum(axis=0).argmax()] > 0 if codes else np.zeros(len(own), bool)
        new = np.flatnonzero(~old)
        links, root, some = np.zeros(len(own), np.int64), np.arange(len(own)), np.zeros(len(own), bool)
        for at in range(0, len(new), STRIP):
            rows = new[at : at + STRIP]
            like = x[rows] @ x.T
            linked = like >= threshold - 1e-9
            a, b = np.nonzero(linked & (like < threshold + 1e-9))
            p, q = raw[rows[a]], raw[b]  # decide by the plain formula
            far = np.einsum("ij,ij->i", p, q) / (np.sqrt(np.einsum("ij,ij->i", p, p)) * np.sqrt(np.einsum("ij,ij->i", q, q))) < threshold
            linked[a[far], b[far]] = False
            linked[np.arange(len(rows)), rows] = False
            linked &= (part[rows][:, None] != part[None, :]) | (part[rows] == 0)[:, None]
            counted = linked & (member[rows] @ member.T == 0) if codes else linked  # a pair with a smaller common leaf counts there
            links[rows] += counted @ weight
            links[old] += weight[rows] @ counted[:, old]
            some[rows] |= linked.any(axis=1)
            some |= linked.any(axis=0)
            for k, to in zip(rows, linked, strict=True):
                ends = root[np.append(np.flatnonzero(to), k)]
                if ends.min() < ends.max():
                    root[np.isin(root, np.unique(ends))] = ends.min()
        out.append(pd.DataFrame({"id": ids[own], "links": links, "root": ids[own][root]})[some])
    return pd.concat(out) if out else pd.DataFrame({"id": [], "links": [], "root": []})


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``df``: ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    v = F.col("embedding")
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("embedding"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fit_to_link = F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    keyed = rows.withColumn("good", fit_to_link).withColumns({f"k{i}": F.when(F.col("good"), F.xxhash64(F.lit(i), "label", v)) for i in (1, 2)})
    classes = keyed.filter("good").groupBy("k1", "k2").agg(F.min("id").alias("id"), F.countDistinct("id").alias("copies"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    classes = written(classes, "classes")
    n = classes.count()
    sample = classes.select("label", "embedding").filter(F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(n, 1)))).collect()  # about SAMPLE rows
    by_kind: dict[tuple[int, int], list] = {}
    for r in sample:
        by_kind.setdefault((r["label"], len(r["embedding"])), []).append(r["embedding"])
    model = {k: fit(unit(np.array(x)), LEAF * min(1.0, SAMPLE / n), threshold=threshold) for k, x in sorted(by_kind.items())}
    led = written(lead(classes.select("id", "copies", "label", "embedding"), model), "leaves")
    dealt = deal(led.select("id", "copies", "embedding", "leaves", F.explode(F.array_distinct("leaves")).alias("leaf"), F.lit(1).alias("cost")), "leaf", "cost", PILE_ROWS, PILE_ROWS)
    links = written(dealt.groupBy("pile").applyInPandas(lambda pdf: compare(pdf, threshold), "id long, links long, root long"), "links")
    joined = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    direct = links.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.select("k1", "k2", "id", "copies").join(direct, "id", "left").join(joined, "id", "left")
    known = known.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    back = keyed.select("id", "k1", "k2").join(known, ["k1", "k2"], "left")
    component = F.coalesce("component_id", "id")
    return back.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
