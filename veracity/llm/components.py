"""Connected components of an edge table as Spark joins (alternating large-star and small-star)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.shared import cut


class UnionFind:
    """Union-find with path halving; the smaller id is always the root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        p = self.parent
        p.setdefault(x, x)
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest(batches):
    """Each Arrow batch of edges becomes its spanning forest: memory stays within one batch."""
    for b in batches:
        u, v = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        uf = UnionFind()
        for x, y in zip(u.tolist(), v.tolist()):
            uf.union(x, y)
        nodes = [x for x in uf.parent if uf.find(x) != x]
        roots = [uf.find(x) for x in nodes]
        yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the long pairs (u, v); component is the smallest node reachable.

    Edges are first thinned to a forest inside each batch, then large-star and
    small-star rounds run as joins until no edge changes (a logarithmic number
    of rounds). A hub's edges are aggregated map-side and its join is a plain
    equi-join, which adaptive execution splits. An empty edge table gives an
    empty result; nulls and self-loops are ignored.
    """
    e = (edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u <> v")
         .mapInArrow(_forest, "u long, v long")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e, seen = cut(e), None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        seen = state
        both = e.union(e.select("v", "u"))
        low = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select("k", F.least("k", "m").alias("m"))
        large = (e.join(low, e.v == low.k).select(F.col("u"), F.col("m").alias("v"))).filter("u <> v").distinct()
        down = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = (large.join(down, large.u == down.k).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(down.select("k", "m")))
        e = cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

