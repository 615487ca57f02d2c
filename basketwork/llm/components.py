"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketwork.llm.common import stored


def _minima(edges: DataFrame) -> DataFrame:
    """node, low: the least of each node and its neighbours; one row per node and task is shuffled."""
    return edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.union(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    linked = both.join(_minima(both), "node").filter("other > node")
    return linked.select(F.col("other").alias("node"), F.col("low").alias("other")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, are linked to its least neighbour."""
    down = edges.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    linked = down.join(_minima(down), "node")
    return (
        linked.select(F.col("other").alias("node"), F.col("low").alias("other"))
        .union(linked.select("node", F.col("low").alias("other")))
        .filter("node > other")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node with an edge to another node.

    `edges` has columns node and other, in either direction, with repeats and loops allowed.
    Every round is written to the shared folder. The rounds grow with the logarithm of the
    number of nodes; they end when every node is linked to its component and to nothing else.
    """
    current = stored(edges.filter("node <> other").distinct(), "edges")
    before = None
    while True:
        current = stored(_small_star(_large_star(current)), "edges")
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            return current.select("node", F.col("other").alias("component"))
        before = state
