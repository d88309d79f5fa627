"""Connected components of a table of links."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import release
from .scratch import kept


def _forest(batches):
    """Union-find over the links of one task: every node with the least node of its tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    yield pa.RecordBatch.from_arrays(
        [pa.array([root(x) for x in nodes], pa.int64()), pa.array(nodes, pa.int64())], names=["a", "b"])
    nodes = parent = batch = None
    release()


def components(links: DataFrame) -> DataFrame:
    """node, root: every linked node with the least node it is connected with (itself left out).

    Each task first reduces its links to a forest by union-find. Then nodes and their least
    neighbours are exchanged: every link (a, b) of a node's greater neighbours is hung below the
    node's least neighbour, then those of its smaller ones, until nothing changes. The number
    of rounds grows with the logarithm of the longest chain. Steps are joins on a node with
    its minimum, which adaptive execution splits for a node with very many links.
    """
    now = kept(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b")
               .mapInArrow(_forest, "a long, b long").distinct(), "links")
    seen = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        seen = mark
        # Greater neighbours of each node go below its least neighbour.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("low").alias("a"), "b").where("a <> b").distinct()
        large = kept(large, "links-large")
        # Smaller neighbours of each node, and the node, go below the least of them.
        low = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(low, "b").select(F.col("low").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()
        now = kept(small, "links-small")
