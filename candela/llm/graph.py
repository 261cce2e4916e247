"""Connected components of an undirected link table, as alternating large-star and small-star rounds.

Everything stays in Spark tables; each round is written to the shared scratch folder, so lineage stays
short, in as many files as its rows ask for. A round joins edges with one minimum per node (aggregated
map-side), so a hub with very many links is a skewed join at most, which adaptive execution splits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from candela.llm.stages import written


#: A round's table has a file for so many rows, and FILES at least.
FILE_ROWS, FILES = 1 << 16, 8


class Forest:
    """Components of a bounded number of nodes inside a task, from the components ``lab`` on; ``links`` keeps one link for each time
    two of them join, so at most one less than there are nodes, however many links are added."""

    def __init__(self, lab: np.ndarray):
        self.lab, self.links = np.unique(lab, return_inverse=True)[1], []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            p, q = self.lab[i], self.lab[j]
            apart = p != q
            i, j, p, q = i[apart], j[apart], p[apart], q[apart]
            if not len(i):
                return
            high, at = np.unique(np.maximum(p, q), return_index=True)   # every higher label joins a lower one: no circles
            self.links.append((i[at], j[at]))
            to = np.arange(len(self.lab))
            to[high] = np.minimum(p, q)[at]
            while not np.array_equal(to, step := to[to]):
                to = step
            self.lab = to[self.lab]


def _with_low(pairs: DataFrame) -> DataFrame:
    """(node, other) -> (node, other, low): low is the smallest of the node and its others."""
    low = pairs.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("low"))
    return pairs.join(low, "node")


def components(links: DataFrame) -> DataFrame:
    """``links`` has columns a and b (any ordered type). Returns (node, label) for every node of a link, label the
    smallest node reachable."""
    seen = Observation()
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct()
    edges = written(edges.observe(seen, F.count("*").alias("n")), "links")
    n = seen.get["n"]
    while True:
        # a round gives each edge's end one edge and each node one: twice as many at most
        files = max(FILES, -(-2 * n // FILE_ROWS))
        both = edges.union(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _with_low(both).filter(F.col("other") > F.col("node")).select(F.col("other").alias("node"), F.col("low").alias("other"))
        large = large.filter("node <> other").distinct()
        s = _with_low(large)
        small = s.select(F.col("other").alias("node"), F.col("low").alias("other")).union(s.select("node", F.col("low").alias("other")))
        edges = written(small.filter("node <> other").distinct().coalesce(files), "links")
        # done when every node has one edge and no edge's end has an edge of its own
        ends = edges.select("node", F.lit(1).alias("own")).union(edges.select("other", F.lit(0)))
        ends = ends.groupBy("node").agg(F.sum("own").alias("own"), F.min("own").alias("least"))
        state = ends.agg(F.coalesce(F.sum("own"), F.lit(0)).alias("n"), F.count_if(F.expr("own > 1 or own = 1 and least = 0")).alias("open")).first()
        n = state["n"]
        if not state["open"]:
            break
    labels = edges.select("node", F.col("other").alias("label"))
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct().coalesce(files))
