"""Connected components of a graph in a table, by hooking to the smallest neighbour and contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.scratch import Scratch


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node``, ``comp`` for every end of ``edges`` (a, b); comp is the smallest node reachable.

    Each turn every node hooks to its smallest neighbour, skips to that one's own choice, and edges are
    rewritten between the places reached, until none is left.  A star, however large, takes two turns, as
    its leaves are pre-aggregated by ``min``; nothing is gathered by node.  Every table is written out.
    """
    live, labels = scratch.keep(_tidy(edges)), None
    while not live.isEmpty():
        ends = live.select("a", "b").union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("p"))
        second = first.select(F.col("node").alias("p"), F.col("p").alias("up"))
        up = scratch.keep(first.join(second, "p").select("node", "up"))
        to = lambda end: up.select(F.col("node").alias(end), F.col("up").alias(f"up_{end}"))
        moved = live.join(to("a"), "a").join(to("b"), "b").select(F.col("up_a").alias("a"), F.col("up_b").alias("b"))
        after = scratch.keep(_tidy(moved))
        if labels is None:
            labels = up.withColumnRenamed("up", "comp")
        else:
            relabelled = labels.join(up.withColumnRenamed("node", "comp"), "comp", "left")
            labels = scratch.keep(relabelled.select("node", F.coalesce("up", "comp").alias("comp")))
        scratch.drop(live)
        live = after
    return live.select(F.col("a").alias("node"), F.col("b").alias("comp")) if labels is None else labels


class Forest:
    """Which of a group's rows are joined, each by the smallest row reachable."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def apart(self, a: slice, b: slice) -> np.ndarray:
        return self.root[a, None] != self.root[None, b]

    def join(self, linked: np.ndarray, a: slice, b: slice) -> None:
        """Join by links between rows ``a`` and rows ``b``.

        Each turn every row hooks to the first of its partners in another tree, until all links lie within trees.
        """
        while True:
            apart = linked & self.apart(a, b)
            rows = np.flatnonzero(apart.any(axis=1))
            if not len(rows):
                return
            for x, y in zip(self.root[a][rows].tolist(), self.root[b][apart[rows].argmax(axis=1)].tolist()):
                while self.root[x] != x:
                    x = self.root[x]
                while self.root[y] != y:
                    y = self.root[y]
                self.root[max(x, y)] = min(x, y)
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up
