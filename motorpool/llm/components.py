"""Connected components of an edge table by local union-find and star contraction, all in Spark."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorpool.llm.common import written


def _forest(batches):
    """Union-find over the edges of a partition: each node met with the smallest node of its local tree."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.array(nodes, np.int64)), pa.array(np.array([parent[x] for x in nodes], np.int64))], names=["node", "root"]
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge that is not itself the smallest of its component.

    Partitions shrink their edges to spanning forests; then large-star and small-star steps, each a group-by of
    minima, alternate until the edges are stars. Every step is written out, so a lost executor costs one step.
    Edges with a null end count for nothing, repeated edges and loops change nothing, no edges give no rows.
    """
    pairs = edges.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).where("x <> y")
    tree = written(pairs.mapInArrow(_forest, "node bigint, root bigint").distinct(), "forest")
    while True:
        both = tree.select("node", "root").union(tree.select(F.col("root").alias("node"), F.col("node").alias("root")))
        # large-star: every larger neighbour is tied to the smallest of node and neighbours
        least = both.groupBy("node").agg(F.least(F.min("root"), F.first("node")).alias("low"))
        large = both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.col("low").alias("root"))
        large = written(large.where("node <> root").distinct(), "star")
        # small-star: smaller neighbours and the node itself are tied to the smallest neighbour
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(low, "node").select(F.col("root").alias("node"), F.col("low").alias("root"), "low").drop("low")
        following = written(small.union(low.select("node", F.col("low").alias("root"))).where("node <> root").distinct(), "star")
        if not tree.exceptAll(following).head(1) and not following.exceptAll(tree).head(1):
            return following
        tree = following
