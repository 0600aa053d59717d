"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample (``sample_rows``), one task per tree,
and broadcast: their size depends on the parameters only.  Every different
vector is indexed, once per tree, under the leaf it falls into.  A query walks
all trees through one shared priority queue, always continuing where its
distance to the planes crossed so far is smallest, until the leaves it has
seen hold ``search`` times as many vectors as there are.  Queries and vectors
meet by leaf; leaf candidates are scored there, those that may be among the
best with the exact measure, and the best are merged.  Copies of a vector are indexed once with their smallest ids,
which is all that a list of k neighbours can show.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ident, python_ready, written

TREES, DEPTH, LEAF = 6, 8, 48
SAMPLE_ROWS = 16_384
SEARCH = 0.9                    # vectors seen, as a share of all, counted once per tree
PART_ROWS = 20_000              # vectors of a leaf scored together
ASK_ROWS = 100_000              # queries that may meet one leaf part in one task
BLOCK_ROWS = 128                # queries of a leaf scored together
NEAR = 1e-9                     # more than matrix products differ from the exact measure


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors as doubles, without those that take no part: null,
    zero, or with null or non-finite components."""
    v = F.transform("v", lambda x: x.cast("double"))
    d = vectors.where("vec_id IS NOT NULL AND v IS NOT NULL").select("vec_id", v.alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return d.where(F.coalesce(good, F.lit(False)))


def _unit(rows) -> np.ndarray:
    """Rows scaled to length 1 (first by the largest component, so that squares stay finite)."""
    m = np.array(list(rows), dtype=np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


NODE = "tree int, node long, plane array<double>, cut double"


def _fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One tree: random directions, each cut at the median of the sample there."""
    tree = int(key[0])
    rows = rows.sort_values("cls")
    m, rng, out = _unit(rows["v"]), np.random.default_rng(tree), []
    todo = [(1, np.arange(len(m)), 0)]
    while todo:
        node, own, depth = todo.pop()
        plane = rng.standard_normal(m.shape[1])
        plane /= np.linalg.norm(plane)
        if depth >= DEPTH or len(own) <= LEAF:
            continue
        at = m[own] @ plane
        cut = float(np.median(at))
        right = at > cut
        if right.all() or not right.any():
            continue
        out.append((tree, node, plane.tolist(), cut))
        todo += [(2 * node, own[~right], depth + 1), (2 * node + 1, own[right], depth + 1)]
    return pd.DataFrame(out, columns=["tree", "node", "plane", "cut"])


class Forest:
    """``trees`` trees for every length of vectors, one length after the other."""

    def __init__(self, trees: int, lengths: list[int], nodes):
        self.of = {n: range(k * trees, (k + 1) * trees) for k, n in enumerate(lengths)}
        self.trees = [{} for _ in range(trees * len(lengths))]
        for tree, node, plane, cut in nodes:
            self.trees[tree][node] = (np.array(plane), cut)

    def leaves(self, m: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree of its length (trees x rows)."""
        own_trees = self.of[m.shape[1]]
        out = np.ones((len(own_trees), len(m)), np.int64)
        for t, tree in enumerate(own_trees):
            nodes = self.trees[tree]
            todo = [(1, np.arange(len(m)))]
            while todo:
                node, own = todo.pop()
                if node not in nodes or not len(own):
                    out[t, own] = node
                    continue
                plane, cut = nodes[node]
                right = m[own] @ plane > cut
                todo += [(2 * node, own[~right]), (2 * node + 1, own[right])]
        return out

    def search(self, q: np.ndarray, sizes: dict, want: float) -> list[tuple[int, int]]:
        """(tree, leaf) pairs by one priority queue over all trees of its length, until they hold ``want`` vectors."""
        queue = [(0.0, t, 1) for t in self.of[len(q)]]
        out, got = [], 0
        while queue and got < want:
            far, t, node = heapq.heappop(queue)
            nodes = self.trees[t]
            while node in nodes:
                plane, cut = nodes[node]
                gap = float(q @ plane) - cut
                near = 2 * node + (gap > 0)
                heapq.heappush(queue, (far + gap * gap, t, near ^ 1))
                node = near
            n = sizes.get((t, node), 0)
            if n:
                out.append((t, node))
                got += n
        return out


def _rows(column) -> np.ndarray:
    return np.array(list(column), dtype=np.float64)


def _best(q: np.ndarray, asked: np.ndarray, v: np.ndarray, ids: list, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, vec_id, cosine) of each query's ``k`` best ids
    among the vectors' ``ids``: largest cosine, then smallest id, never the
    query's own id."""
    many = np.array([len(x) for x in ids])
    flat, start = np.concatenate([np.asarray(x, np.int64) for x in ids]), np.cumsum(many) - many
    single, own = many == 1, flat[start]
    u, unit = _unit(q), _unit(v)
    (q, q_length), (v, v_length) = _scaled(q), _scaled(v)
    got = []
    for at in range(0, len(q), BLOCK_ROWS):
        s = u[at:at + BLOCK_ROWS] @ unit.T
        s[single & (own == asked[at:at + BLOCK_ROWS, None])] = -np.inf
        floor = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] > k else np.full(len(s), -np.inf)
        row, col = np.nonzero((s >= floor[:, None] - NEAR) & (s > -np.inf))
        row += at
        score = np.zeros(len(row))
        for j in range(q.shape[1]):                 # in component order
            score += q[row, j] * v[col, j]
        score /= q_length[row] * v_length[col]
        each = many[col]
        place = np.arange(each.sum()) + np.repeat(start[col] - np.cumsum(each) + each, each)
        row, col, score, vec_id = np.repeat(row, each), np.repeat(col, each), np.repeat(score, each), flat[place]
        other = np.flatnonzero(vec_id != asked[row])
        other = other[np.lexsort((vec_id[other], -score[other], row[other]))]
        first = np.searchsorted(row[other], row[other])
        other = other[np.arange(len(other)) - first < k]
        got.append((row[other], col[other], vec_id[other], score[other]))
    return tuple(np.concatenate(x) for x in zip(*got))


def _scaled(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled by powers of two, so that squares stay finite, and their
    lengths, summed in component order."""
    m = np.ldexp(m, -np.frexp(np.abs(m).max(axis=1, keepdims=True))[1])
    squares = np.zeros(len(m))
    for j in range(m.shape[1]):
        squares += m[:, j] * m[:, j]
    return m, np.sqrt(squares)


def nearest(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding",
            trees: int = TREES, search: float = SEARCH, sample_rows: int = SAMPLE_ROWS,
            part_rows: int = PART_ROWS, ask_rows: int = ASK_ROWS) -> DataFrame:
    """For each row where ``queries`` (a condition on vec_id) holds its k nearest
    other rows found: query_id, rank (from 1), vec_id, score (cosine).

    Ties go to the smaller vec_id.  Rows that take no part (see
    :func:`usable`) are neither queries nor candidates.  Rows that share a
    query's vec_id are its own and no candidates; several vectors under one
    query id count as the least of them.  Repeated rows count once.
    Vectors meet those of their own length only, each length with its own trees.
    """
    spark = vectors.sparkSession
    python_ready(spark, 5000)
    d = usable(vectors.select(ident(vec_id).cast("long").alias("vec_id"), ident(embedding).alias("v"))).distinct()
    d = d.withColumn("cls", F.struct(F.xxhash64("v").alias("a"), F.hash("v").alias("b")))
    place = F.row_number().over(Window.partitionBy("cls").orderBy("vec_id"))
    some = d.withColumn("place", place).where(F.col("place") <= k + 1)
    classes = some.groupBy("cls").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v"))
    classes = written(classes, "ann-classes")
    many = {r["size"]: r["count"] for r in classes.groupBy(F.size("v").alias("size")).count().collect()}     # one row per length
    lengths = sorted(many)
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    of_length = F.element_at(F.create_map(*(F.lit(x) for k, n in enumerate(lengths) for x in (n, k))), F.size("v"))
    count = F.element_at(F.create_map(*(F.lit(x) for n in lengths for x in (n, many[n]))), F.size("v"))
    asks = written(d.where(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q")), "ann-queries")

    chosen = F.pmod(F.xxhash64(F.lit("sample"), "cls.a"), F.lit(1 << 30)) < F.floor(F.lit(sample_rows * (1 << 30)) / count)
    sample = classes.where((count <= sample_rows) | chosen)
    sample = sample.select("cls", "v", F.explode(F.sequence(of_length * trees, of_length * trees + trees - 1)).alias("tree"))
    sample = sample.select("tree", F.concat_ws("/", "cls.a", "cls.b").alias("cls"), "v")
    nodes = sample.groupBy("tree").applyInPandas(_fit, NODE).collect()          # trees * 2**DEPTH planes a length at most
    forest = spark.sparkContext.broadcast(Forest(trees, lengths, [tuple(r) for r in nodes]))

    def route(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for n, own in p.groupby(p["v"].map(len)):
                at = forest.value.leaves(_unit(own["v"]))
                for t, tree in enumerate(forest.value.of[n]):
                    yield own.assign(tree=tree, leaf=at[t])[["tree", "leaf", "a", "b", "ids", "v"]]

    index = classes.select("cls.a", "cls.b", "ids", "v").mapInPandas(route, "tree int, leaf long, a long, b int, ids array<long>, v array<double>")
    index = written(index, "ann-index")
    sizes = {(r["tree"], r["leaf"]): r["count"] for r in index.groupBy("tree", "leaf").count().collect()}   # one row per leaf
    split = 1 + max(sizes.values(), default=0) // part_rows
    shares = 1 + asks.count() // ask_rows           # by query id; each share meets its own copy of the leaf parts
    want = {n: max(search * c, 40.0 * (k + 1) * trees) for n, c in many.items()}

    def walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            if not len(p):
                continue
            units = (_unit([q])[0] for q in p["q"])
            out = [(t, leaf, i) for i, q in enumerate(units) for t, leaf in forest.value.search(q, sizes, want[len(q)])]
            at = [i for _, _, i in out]
            yield pd.DataFrame({"tree": [t for t, _, _ in out], "leaf": [x for _, x, _ in out],
                                "query_id": p["query_id"].to_numpy()[at], "q": p["q"].to_numpy()[at]})

    visits = asks.mapInPandas(walk, "tree int, leaf long, query_id long, q array<double>")
    visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(split - 1))))
    visits = visits.withColumn("share", F.pmod(F.xxhash64("query_id"), F.lit(shares)).cast("int"))
    index = index.withColumn("part", F.pmod("a", F.lit(split)).cast("int"))
    index = index.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "a": [], "b": [], "vec_id": [], "score": []})
        asked = left["query_id"].to_numpy()
        row, col, vec_id, score = _best(_rows(left["q"]), asked, _rows(right["v"]), right["ids"].tolist(), k)
        return pd.DataFrame({"query_id": asked[row], "a": right["a"].to_numpy()[col], "b": right["b"].to_numpy()[col], "vec_id": vec_id, "score": score})

    on = ("tree", "leaf", "part", "share")
    found = visits.groupBy(*on).cogroup(index.groupBy(*on)).applyInPandas(score, "query_id long, a long, b int, vec_id long, score double")
    found = found.groupBy("query_id", "a", "b", "vec_id").agg(F.first("score").alias("score"))      # the same from every tree
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
