"""Connected components of an edge table by randomised contraction.

Each round lets every node point to the neighbour (or itself) that comes first in a pseudo-random
order, replaces edges by edges between the nodes pointed to, and drops loops and repeats. The edges
shrink by a constant factor a round, so the rounds grow with the logarithm of the largest component.
Each round is stored; then the pointers are followed back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmetrics.llm.common import stored


def _first(node: str):
    """The order of a round: by hash, then by number."""
    return F.struct(F.xxhash64(node).alias("order"), F.col(node).alias("node"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v), both long; equal roots are one component."""
    spark = edges.sparkSession
    straight = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    left = stored(straight.distinct(), "edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min(_first("v")).alias("near"))
        points = stored(nearest.select(F.col("u").alias("node"), F.least(F.col("near"), _first("u"))["node"].alias("root")), "pointers")
        rounds.append(points)
        moved = (
            left.join(points.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u")
            .join(points.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v")
            .where("ru <> rv")
        )
        left = stored(moved.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), "edges")
    if not rounds:
        return spark.createDataFrame([], "node long, root long")
    roots = rounds[-1]
    for points in reversed(rounds[:-1]):
        above = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots = points.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return roots


def smallest_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, component_id): the smallest id among the members (node, id) of each node's component."""
    grouped = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    grouped = stored(grouped, "members")
    least = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    return grouped.join(least, "root").select("node", "component_id")
