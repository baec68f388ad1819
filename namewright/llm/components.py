"""Connected components of a graph held in DataFrames, by randomised contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namewright.sources.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(src, dst) long -> (id, component), one row per node with an edge to another node.

    ``component`` is the smallest id that the node reaches. In each round every node points to the
    neighbour, or itself, of lowest random priority, and the edges are rewritten to what their ends
    point to. The number of nodes shrinks by a constant factor a round whatever the shape (paths and
    stars included), so the rounds grow with the logarithm of the largest component. A round takes a
    minimum per node, which combines before the shuffle, and two joins against unique keys. Its
    tables are staged in the shared folder: lost executors cost no earlier round. Nothing of the
    graph reaches the driver. Null ends and self loops are ignored.
    """
    current = stage(
        edges.select(F.col("src").cast("long"), F.col("dst").cast("long")).where("src <> dst"), "edges"
    )
    pointers: list[DataFrame] = []
    while not current.isEmpty():
        pointers.append(stage(_point(current, len(pointers)), "pointers"))
        node = pointers[-1]
        left = node.select(F.col("node").alias("src"), F.col("parent").alias("_src"))
        right = node.select(F.col("node").alias("dst"), F.col("parent").alias("_dst"))
        contracted = current.join(left, "src").join(right, "dst").where("_src <> _dst")
        low, high = F.least("_src", "_dst"), F.greatest("_src", "_dst")
        current = stage(contracted.select(low.alias("src"), high.alias("dst")).distinct(), "edges")
    if not pointers:
        return current.select(F.col("src").alias("id"), F.col("dst").alias("component"))
    roots = pointers[0].select(F.col("node").alias("id"), F.col("parent").alias("root"))
    for step in pointers[1:]:
        step = step.select(F.col("node").alias("root"), F.col("parent").alias("_next"))
        roots = roots.join(step, "root", "left").select("id", F.coalesce("_next", "root").alias("root"))
    roots = stage(roots, "roots")
    smallest = roots.groupBy("root").agg(F.min("id").alias("component"))
    return roots.join(smallest, "root").select("id", "component")


def _point(edges: DataFrame, turn: int) -> DataFrame:
    def priority(name: str):
        return F.xxhash64(F.lit(turn), F.col(name))

    both = edges.select("src", "dst").union(edges.select("dst", "src"))
    best = both.groupBy(F.col("src").alias("node")).agg(
        F.min(F.struct(priority("dst").alias("priority"), F.col("dst").alias("id"))).alias("best")
    )
    closer = F.struct(priority("node").alias("priority"), F.col("node").alias("id"))
    return best.select("node", F.least("best", closer)["id"].alias("parent"))


def merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give both ends of every pair the same, lowest, root; ``root`` stays flat."""
    while True:
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        apart = low != high
        if not apart.any():
            return
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root[:] = root[root]
