"""Connected components by alternating large-star and small-star, on DataFrames.

Hot nodes: both operations need only the least neighbour of a node, which a grouped minimum (combined before the
shuffle) finds; it is written out and joined back, so that Spark can split a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) -> new edges.  Large-star: strictly larger neighbours meet the least of {u} and its neighbours;
    small-star: smaller neighbours and u itself do."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = durable(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "cc-least")
    met = both.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the least node reachable, for every node with an edge."""
    edges = durable(edges.select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).where("u <> v").distinct(), "cc-edges")
    before = None
    for _ in range(rounds):
        edges = durable(_star(durable(_star(edges, True), "cc-large"), False), "cc-small")
        # a fixed point: every edge is a star to its least node
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return edges.groupBy("u").agg(F.min("v").alias("component")).unionByName(edges.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct()).groupBy(F.col("u").alias("node")).agg(F.min("component").alias("component"))
