"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from viewtide.session import settled


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("b").alias("a"), F.col("a").alias("b"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(_turned(edges))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    linked = both.join(least, "a").where("b > a")
    return linked.select(F.col("b").alias("a"), F.least("least", "a").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these. Edges go from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of a set of edges."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def components(edges: DataFrame) -> DataFrame:
    """The smallest node ``root`` that each ``node`` of ``edges`` (a, b) can reach, for nodes that are not their own root.

    Nodes are numbers. Stars around large and small neighbours take turns until nothing changes,
    which takes a number of rounds that grows as the logarithm of the longest path. Each round is
    written out, so plans stay short and a lost executor costs no earlier round. Loops and repeated
    edges change nothing; without edges the result is empty.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = settled(edges.where("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct())
    mark = _mark(edges)
    while mark[0]:
        edges = settled(_small_star(_large_star(edges)))
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
