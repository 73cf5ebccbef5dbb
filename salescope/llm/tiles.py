"""Near-duplicate vectors of equal label, by int8 tile products with error bounds.

Vectors are scaled to length one and rounded to 8-bit whole numbers times one scale each.  For a vector
u = s q + e the length of e is known, so the true cosine of two vectors differs from s s' (q . q') by at most
|s q| |e'| + |e|, which holds whatever the data.  A label's vectors are dealt into tiles of about ``TILE``; two tiles meet in
one group, where the products of their whole numbers are taken square by square (exactly: as floats
below 2^24).  Pairs whose product plus bound stays below the threshold are gone; only pairs that may lie on
either side of it are recomputed from the original vectors in double precision, and those whose product minus bound
reaches it are links as they are.

Links are not sent on as pairs.  A group sends for each of its vectors the number of links and its smallest
partner reachable inside the group, at most two rows a vector, so a crowd of near copies costs no more than any other vectors.
Equal vectors of one label are one node with a multiplicity.

The products of a label grow with the square of its different vectors, as an exact comparison by tiles does; a vector is sent to as
many groups as its label has tiles.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite
components link with nothing, nor do rows without a label or an id (whose component is null).  Every row is
a vector of its own; rows that repeat an id have one component.  An empty table gives an empty result.
Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.components import Forest, components
from salescope.llm.scratch import Scratch
from salescope.session import spread

THRESHOLD = 0.93
TILE = 8_192
SQUARE = 1_024  # rows and columns of the products taken at once
DEPTH = 1_024  # components multiplied at once: 127 * 127 * 1024 is below 2^24, where floats are exact
_SLACK = 1e-9  # for the rounding of doubles


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers q of the unit vectors, scales s, |s q|, and |u - s q|."""
    top = np.abs(v).max(axis=1, keepdims=True)
    u = v / top  # lengths of huge or tiny vectors don't overflow
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    s = np.abs(u).max(axis=1) / 127
    q = np.rint(u / s[:, None])
    rounded = q * s[:, None]
    length = lambda x: np.sqrt((x * x).sum(axis=1))
    return q.astype(np.int8), s, length(rounded), length(u - rounded)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of whole-number rows, as doubles."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], DEPTH):
        total += a[:, at : at + DEPTH].astype(np.float32) @ b[:, at : at + DEPTH].astype(np.float32).T
    return total


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision; lengths can't overflow."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


class Links:
    """Links among the rows of ``v``: how many each has, by multiplicity ``n``, and which rows they join."""

    def __init__(self, v: np.ndarray, n: np.ndarray, threshold: float, square: int = SQUARE):
        self.v, self.n, self.threshold, self.square = v, n, threshold, square
        self.q, self.s, self.length, self.error = quantised(v)
        self.count = np.zeros(len(v), np.int64)
        self.trees = Forest(len(v))
        self.recomputed = 0

    def _square(self, a: slice, b: slice, same: bool) -> np.ndarray:
        near = products(self.q[a], self.q[b])
        near *= self.s[a, None]
        near *= self.s[None, b]
        off = self.length[a, None] * self.error[None, b]
        off += self.error[a, None] + _SLACK
        linked = near - off >= self.threshold
        unsure = (near + off >= self.threshold) & ~linked
        if same:
            linked, unsure = np.triu(linked, 1), np.triu(unsure, 1)
        i, j = np.nonzero(unsure)
        for at in range(0, len(i), 65_536):
            x, y = i[at : at + 65_536], j[at : at + 65_536]
            hit = cosines(self.v[a][x], self.v[b][y]) >= self.threshold
            linked[x[hit], y[hit]] = True
        self.recomputed += len(i)
        return linked

    def between(self, a: range, b: range) -> None:
        """All links of rows in ``a`` with rows in ``b``, which is the same range or a later one."""
        for i in range(a.start, a.stop, self.square):
            rows = slice(i, min(i + self.square, a.stop))
            for j in range(i if a == b else b.start, b.stop, self.square):
                columns = slice(j, min(j + self.square, b.stop))
                linked = self._square(rows, columns, rows == columns)
                if linked.any():
                    self.count[rows] += linked @ self.n[columns]
                    self.count[columns] += self.n[rows] @ linked
                    self.trees.join(linked, rows, columns)


def _meet(threshold: float, dim: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("own").to_numpy() != table.column("first").to_numpy(), kind="stable")
        node, n = table.column("node").to_numpy()[order], table.column("n").to_numpy()[order]
        v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)[order]
        cut = int((table.column("own").to_numpy() == table.column("first").to_numpy()).sum())
        links = Links(v, n, threshold)
        if table.column("first")[0].as_py() == table.column("second")[0].as_py():
            links.between(range(0, cut), range(0, cut))
        else:
            links.between(range(0, cut), range(cut, len(node)))
        hit = np.flatnonzero(links.count)
        return pa.table({"node": node[hit], "root": node[links.trees.root[hit]], "links": links.count[hit]})

    return run


def _fine(v: Column, label: Column, row_id: Column) -> Column:
    """Whether a row can link, its length aside; never null."""
    numbers = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return label.isNotNull() & row_id.isNotNull() & F.coalesce(numbers, F.lit(False))


def usable(vectors: DataFrame, vector: Column, label: Column) -> tuple[DataFrame, int]:
    """Rows (id, label, v) that can link, and their number of components: that of most rows, ties to the smaller."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), vector.cast("array<double>").alias("v"))
    rows = rows.filter(_fine(F.col("v"), F.col("label"), F.col("id")))
    top = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim = top["dim"] if top else 1
    return rows.filter(F.size("v") == dim), dim


def link_counts(nodes: DataFrame, dim: int, threshold: float, tile: int = TILE) -> DataFrame:
    """``node``, ``root`` (joined with it), ``links`` of every node (label, node, n, v) and pair of tiles in which it has links."""
    sizes = nodes.groupBy("label").agg(F.count("*").alias("size"))
    tiles = nodes.join(sizes, "label").withColumn("tiles", F.ceil(F.col("size") / tile).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    # Tile t meets tile u in group (the smaller, the larger); with itself once.
    met = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda u: F.struct(F.least("own", u).alias("first"), F.greatest("own", u).alias("second")))
    sent = tiles.withColumn("own", own).select("label", "own", F.explode(met).alias("m"), "node", "n", "v").select("label", "m.*", "own", "node", "n", "v")
    return spread(sent, "label", "first", "second").groupBy("label", "first", "second").applyInArrow(_meet(threshold, dim), "node long, root long, links long")


def near_vectors(vectors: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, vector: Column | None = None, label: Column | None = None, tile: int = TILE) -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id (the smallest id reachable), kept."""
    vector, label = F.col("embedding") if vector is None else vector, F.col("label") if label is None else label
    rows, dim = usable(vectors, vector, label)
    groups = rows.groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    nodes = scratch.keep(groups.select(F.monotonically_increasing_id().alias("node"), "label", "v", "least", "n"))
    found = scratch.keep(link_counts(nodes, dim, threshold, tile))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))

    # Rows and their nodes; ids that are held by several nodes join these.
    held = scratch.keep(rows.join(nodes.select("label", "v", "node", "n"), ["label", "v"]).select("id", "node", "n"))
    several = held.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b").select("id", "a")
    shared = held.join(several, "id").filter("a <> node").select("a", F.col("node").alias("b"))
    joined = components(found.filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")).union(shared), scratch)
    comp = nodes.select("node", "least").join(joined, "node", "left").select("node", "least", F.coalesce("comp", "node").alias("comp"))
    least = comp.groupBy("comp").agg(F.min("least").alias("component"))
    known = comp.join(least, "comp").join(links, "node", "left").select("node", "component", F.coalesce("links", F.lit(0)).alias("links"))
    placed = held.join(known, "node").select("id", "component", (F.col("links") + F.col("n") - 1).alias("n_links"))

    takes_part = placed.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))
    # The other rows: an id that also takes part keeps its component.
    v = vector.cast("array<double>")
    out = ~_fine(v, label, F.col("vec_id")) | (F.size(v) != dim)
    of_id = placed.groupBy("id").agg(F.min("component").alias("component"))
    rest = vectors.filter(out).select(F.col("vec_id").cast("long").alias("vec_id")).join(of_id, F.col("vec_id") == F.col("id"), "left")
    component = F.coalesce("component", "vec_id")
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
    return takes_part.union(alone)
