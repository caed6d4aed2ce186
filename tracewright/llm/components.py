"""Connected components of a table of edges, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.session import materialize

MAX_ROUNDS = 60


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node on an edge (a, b); a component is named by its smallest node.

    Every round is two aggregations and two joins on node ids; its edges, no more than before,
    are written once. Hubs are pre-aggregated, and the joins can be cut by the adaptive skew
    join. Rounds grow with the logarithm of a component's diameter, and end when nothing changes.
    """
    edges = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    before = _print_of(edges)
    for _ in range(MAX_ROUNDS):
        edges = materialize(_small_star(_large_star(edges)))
        now = _print_of(edges)
        if now == before:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
