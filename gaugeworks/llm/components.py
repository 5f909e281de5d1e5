"""Connected components by alternating large-star and small-star joins.

Nodes and edges never leave the executors. Each round is written to the shared
folder, which ends its lineage. Rounds grow with the logarithm of the longest
chain. A node with very many edges is aggregated before the shuffle, and its
join is one that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` lead from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(least.select("a", F.col("low").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())


def components(edges: DataFrame) -> DataFrame:
    """``a`` and ``b`` of each edge -> ``node`` and ``component``, its smallest reachable node.

    Nodes without edges, or with an edge to themselves only, are not returned.
    """
    edges = stage(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = stage(_small_star(_large_star(edges)), "stars")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
