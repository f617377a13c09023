"""Connected components of an undirected graph as Spark jobs.

Alternates the large-star and small-star steps of Kiveris et al., "Connected
Components in MapReduce and Beyond" (2014): each step moves every neighbour of
a node to the smallest one it knows. A node's smallest neighbour is a grouped
minimum (combined before the shuffle) that is joined back, so a node with very
many neighbours is never gathered in one task; the join's skew is left to
adaptive execution. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bayline.llm.staging import staged


def _canonical(edges: DataFrame) -> DataFrame:
    return (edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .where("u <> v").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    # rows (u, v) with v < u: every v and u itself move to the smallest v
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that has a link, ``component``
    being the smallest node reachable. ``edges``: two columns of longs; loops,
    repeated and reversed rows are allowed, rows with a null are left out. An
    empty table gives an empty result."""
    edges = edges.toDF("u", "v").where("u is not null and v is not null")
    cur = staged(_canonical(edges), "cc-edges")
    mark = None
    for _ in range(max_rounds):
        cur = staged(_canonical(_small_star(_canonical(_large_star(cur)))), "cc-round")
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
