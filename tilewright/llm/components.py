"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import cut, release


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of each node u to the smallest of u and its neighbours: the larger ones (large) or the smaller ones and u.

    Minima are combined before the shuffle. The join on u has many rows only for hubs; adaptive execution splits those.
    """
    both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    joined = both.join(least, F.col("u") == F.col("k"))
    if large:
        linked = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                 F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
    return linked.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node on an edge of (u, v); root is the smallest node reachable.

    Each node of larger id points at a smaller one, so the number of rounds grows with the logarithm of the longest path.
    The driver sees two numbers a round. Self-loops and null ends are left out; no edges give no rows.
    """
    edges = cut(edges.where("u is not null and v is not null and u != v")
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        before, edges = edges, cut(_star(_star(edges, True), False))
        release(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    found = cut(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots))
    release(edges)
    return found
