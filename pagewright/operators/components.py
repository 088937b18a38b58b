"""Connected components of a distributed edge list.

Alternating large-star and small-star steps: every node is hooked onto the smallest node it knows
until each component is a star around its smallest node. Each step is two shuffles of the edge list;
edge lists are written to the shared folder between rounds, so lineage stays short and a lost
executor costs one round at most. Nothing is collected but two numbers a round.

A graph of long nodes with at most ``FEW_EDGES`` edges is not worth those rounds, each of which
costs tasks and files as many as there are partitions: its edges (16 bytes each) go to the driver,
which joins their sets. Both ways give the same components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright import scratch

#: Edges that the driver takes on by itself.
FEW_EDGES = 100_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    lowest = scratch.table(both.groupBy("src").agg(F.min("dst").alias("low")), "cc-low")
    lowest = lowest.select("src", F.least("src", "low").alias("low"))
    return both.join(lowest, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    lowest = scratch.table(down.groupBy("src").agg(F.min("dst").alias("low")), "cc-low")
    moved = down.join(lowest, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(lowest.select("src", F.col("low").alias("dst")))


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _is_star(edges: DataFrame) -> bool:
    """Whether every edge goes from a node with one target to a node without any."""
    down = edges.select("src").distinct()
    forks = edges.groupBy("src").agg(F.count("*").alias("n")).where("n > 1")
    return forks.isEmpty() and edges.select(F.col("dst").alias("src")).join(down, "src", "left_semi").isEmpty()


def _joined(edges: pa.Table) -> pa.Table:
    """``(node, component)`` of all nodes, by disjoint sets whose root is their smallest node."""
    nodes, at = np.unique(np.concatenate([edges[c].to_numpy() for c in ("src", "dst")]), return_inverse=True)
    root = list(range(len(nodes)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    for a, b in at.reshape(2, -1).T.tolist():
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    least = nodes[[find(k) for k in range(len(nodes))]]
    return pa.table({"node": pa.array(nodes, pa.int64()), "component": pa.array(least, pa.int64())})


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 40) -> DataFrame:
    """``(node, component)`` for every node that has an edge to another; component: its smallest node.

    Self-loops and edges with a null end are ignored. Node columns may have any orderable type.
    """
    edges = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src <> dst")
    edges = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    if {kind for _, kind in edges.dtypes} == {"bigint"}:
        edges = scratch.table(edges, "cc-given")  # computed once, whichever way they go
        if 0 < edges.count() <= FEW_EDGES:
            return scratch.table(edges.sparkSession.createDataFrame(_joined(edges.toArrow())), "cc-labels")
    edges = scratch.table(edges.distinct(), "cc-edges")
    seen = None
    for _ in range(max_rounds):
        if _is_star(edges):
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
                edges.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            )
        edges = scratch.table(_large_star(edges).distinct(), "cc-edges")
        edges = scratch.table(_small_star(edges).distinct(), "cc-edges")
        now = _print_of(edges)
        if now == seen:
            raise RuntimeError("components did not converge to stars")
        seen = now
    raise RuntimeError(f"components did not converge in {max_rounds} rounds")
