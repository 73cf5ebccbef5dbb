"""Nearest neighbours by vantage-point trees, one per shard.

A node of a tree holds a vantage vector and the median distance of the others to it, which parts them
into an inner and an outer half.  A search goes into a half only where the triangle inequality can't
exclude it: the distance of the query to the shell between the halves, times ``factor``, must not
exceed the distance of the worst neighbour found so far.  Factor 1 is exact; more prunes more and may
miss neighbours.  Queries descend together, block by block, with numpy over the queries that are
still interested in a node.  Shards and query blocks meet as groups of bounded size.

Nearness is the Euclidean distance of the original vectors in double precision, summed component by
component; ties go to the smaller id.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, nor do rows without an id.  A query gets all candidates where there are fewer
than asked for.  Rows that repeat an id are candidates each for itself, but never of their own id.
Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD = 16_384  # vectors in a tree, about
QUERIES = 2_048  # queries that meet a shard in one group, about
LEAF = 128
FACTOR = 1.0
_SLACK = 1e-9  # for the rounding of distances


def distances(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """All distances between rows of ``q`` and of ``v``; sums go over the components in order."""
    total = np.zeros((len(q), len(v)))
    for k in range(q.shape[1]):
        step = q[:, k, None] - v[None, :, k]
        step *= step
        total += step
    return np.sqrt(total, out=total)


class Tree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 0):
        self.ids, self.vectors, self.rng = ids, vectors, np.random.default_rng(seed)
        self.root = self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        pick = int(self.rng.integers(len(rows)))
        vantage, rest = rows[pick], np.delete(rows, pick)
        d = distances(self.vectors[[vantage]], self.vectors[rest])[0]
        shell = float(np.median(d))
        inner = d <= shell
        if inner.all():  # many equal vectors: halve them by position
            inner = np.arange(len(rest)) < len(rest) // 2
            return vantage, None, self._build(rest[inner]), self._build(rest[~inner])
        return vantage, shell, self._build(rest[inner]), self._build(rest[~inner])

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances (infinite: none) and ids of the ``k`` nearest of each query, nearest first."""
        self.q, self.qid, self.factor = queries, ids, factor
        self.far = np.full((len(ids), k), np.inf)
        self.near = np.full((len(ids), k), -1, dtype=np.int64)
        self._visit(self.root, np.arange(len(ids)))
        return self.far, self.near

    def _offer(self, at: np.ndarray, d: np.ndarray, rows: np.ndarray) -> None:
        d = np.where(self.qid[at, None] == self.ids[rows][None, :], np.inf, d)
        k = self.far.shape[1]
        better = (d <= self.far[at, -1:]).any(axis=1)
        at, d = at[better], d[better]
        if not len(at):
            return
        far = np.concatenate([self.far[at], d], axis=1)
        ids = np.concatenate([self.near[at], np.broadcast_to(self.ids[rows], d.shape)], axis=1)
        order = np.lexsort((ids, far), axis=1)[:, :k]
        self.far[at] = np.take_along_axis(far, order, axis=1)
        self.near[at] = np.take_along_axis(ids, order, axis=1)

    def _visit(self, node, at: np.ndarray) -> None:
        if not len(at):
            return
        if isinstance(node, np.ndarray):
            if len(node):
                self._offer(at, distances(self.q[at], self.vectors[node]), node)
            return
        vantage, shell, inner, outer = node
        d = distances(self.q[at], self.vectors[[vantage]])
        self._offer(at, d, np.array([vantage]))
        if shell is None:
            self._visit(inner, at)
            self._visit(outer, at)
            return
        gap = d[:, 0] - shell
        inside = gap <= 0
        self._visit(inner, at[inside])
        self._visit(outer, at[~inside])
        worth = self.factor * np.abs(gap) <= self.far[at, -1] * (1 + _SLACK) + _SLACK
        self._visit(outer, at[inside & worth])
        self._visit(inner, at[~inside & worth])


def _vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, vector: Column) -> tuple[DataFrame, int]:
    """Rows (id, v) that take part, and their number of components: that of most rows, ties to the smaller."""
    v = vector.cast("array<double>")
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).filter(F.coalesce(fine, F.lit(False)) & F.col("id").isNotNull())
    top = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim = top["dim"] if top else 1
    return rows.filter(F.size("v") == dim), dim


def nearest(vectors: DataFrame, k: int = 10, query_step: int = 100, factor: float = FACTOR, vector: Column | None = None) -> DataFrame:
    """For every id divisible by ``query_step``: query_id, rank, vec_id, score of the ``k`` nearest others."""
    rows, dim = usable(vectors, F.col("embedding") if vector is None else vector)
    is_query = F.col("id") % query_step == 0
    n, asked = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-asked // QUERIES))
    deal = lambda c, parts, seed: F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(parts)).cast("int")
    every = lambda parts, name: F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias(name)
    # Rows that repeat an id may be many: a row's content takes part in the dealing.
    content = F.struct("id", "v")
    members = rows.select(deal(content, shards, 1).alias("shard"), every(blocks, "block"), F.lit(False).alias("asks"), "id", "v")
    queries = rows.filter(is_query).select(every(shards, "shard"), deal(content, blocks, 2).alias("block"), F.lit(True).alias("asks"), "id", "v")

    def search(table: pa.Table) -> pa.Table:
        asks = np.array(table.column("asks").to_pylist(), dtype=bool)
        ids = table.column("id").to_numpy()
        v = _vectors(table.column("v"), dim)
        order = np.lexsort((*v.T[::-1], ids)) if len(np.unique(ids)) < len(ids) else np.argsort(ids)
        own, q = order[~asks[order]], order[asks[order]]
        far, near = Tree(ids[own], v[own], int(table.column("shard")[0].as_py())).search(ids[q], v[q], k, factor)
        found = ~np.isinf(far)
        return pa.table({"query_id": np.repeat(ids[q], found.sum(axis=1)), "vec_id": near[found], "score": far[found]})

    found = members.union(queries).groupBy("shard", "block").applyInArrow(search, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
