"""Distributed connected components with DataFrame operations only.

Alternating large-star and small-star rounds: each replaces a node's edges by
edges to the smallest node it knows.  A round is a grouped minimum (combined
before the shuffle) joined back to the edges; the join is salted, as the hub of
a star may hold a third of all edges.  Each round's edges are staged in the
shared folder, so lineage stays short.  Nothing but a count and a checksum
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import salted_join, staged, unstage


def _to_least(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with ``m``, the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return salted_join(pairs, least, ["u"], F.col("v"), "inner")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _to_least(down)
    moved = near.select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
    return moved.where("u != v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of an edge.

    Null ends and self-loops make no link; repeated and reversed edges count once.
    """
    now = staged(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v").distinct(), "edges")
    was = None
    while True:
        big = staged(_large_star(now), "large")
        new = staged(_small_star(big), "small")
        unstage(big, now)
        now = new
        got = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if was == (got["n"], got["h"]):
            break
        was = (got["n"], got["h"])
    # all edges now lead from a node to its component's least node
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
