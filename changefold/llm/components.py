"""Connected components of a graph given as a table of edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from changefold.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each neighbour larger than a node to the smallest of the node's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each node, and its neighbours smaller than it, to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b")


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node that has an edge; edges are columns a and b, of longs.

    Both stars keep the graph's components and replace hubs by their smallest neighbour; when neither
    changes anything, every node is tied to its component's smallest. Each step reads a written table.
    """
    edges = staged(edges.select("a", "b").where("a <> b").distinct(), "components")
    before = _print(edges)
    while before[0]:
        edges = staged(_small_star(_large_star(edges)).distinct(), "components")
        after = _print(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
