"""Connected components of a graph that lives in tables.

Alternates the large-star and small-star steps (Kiveris et al., 2014): each
step joins every edge with the smallest neighbour of its node, so the largest
shuffle is the edge table, and the number of rounds grows with the logarithm
of the number of nodes.  Edges are stored in the shared checkpoint folder after
each round; only counts of them reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.session import delete_path, materialise


def _star(edges: DataFrame, large: bool) -> tuple[DataFrame, str]:
    """One star step over edges (u, v) with u > v: (new edges with u > v, where they are stored)."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Stored first, so that both sides of the join are plain shuffles: the edges
    # of a node with very many are split by adaptive execution.
    least, least_path = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("m", "u").alias("m")), "cc-least")
    joined = both.join(least, both["u"] == least["node"])
    if large:
        # Neighbours above the node move to its smallest neighbour.
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # The node and its smaller neighbours move to the smallest of them.
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("node").alias("u"), F.col("m").alias("v")))
    out, path = materialise(out.where(F.col("u") != F.col("v")).distinct(), "cc-edges")
    delete_path(edges.sparkSession, least_path)
    return out, path


def _is_star(edges: DataFrame) -> bool:
    """Whether every node u has one v, and no v has a smaller one."""
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("nodes")).first()
    heads = edges.select(F.col("u").alias("v"))
    return r.n == r.nodes and edges.select("v").join(heads, "v", "left_semi").isEmpty()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each node of an edge is linked with."""
    now, path = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                            .where(F.col("u") != F.col("v")).distinct(), "cc-edges")

    while not _is_star(now):
        for large in (True, False):
            after, new_path = _star(now, large)
            delete_path(now.sparkSession, path)
            now, path = after, new_path
    # Every node now points at the smallest one of its component.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
