"""Connected components of a table of links by large-star / small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import saved


def connected_components(links: DataFrame) -> DataFrame:
    """links(a, b): any orderable type.  Returns (node, root): the smallest node of each component,
    for every node with a link to another one.

    Each step keeps the edges as a table in the shared folder.  A star step only aggregates a
    minimum per node (combined before the shuffle) and joins it back, which adaptive execution
    may split for a hub, so no neighbourhood is gathered anywhere."""
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if edges.isEmpty():
        return edges.selectExpr("u as node", "v as root")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        step = saved(small, "edges")
        # done when every node has one edge and no root is itself below another node
        if step.count() == edges.count() and step.join(edges, ["u", "v"], "left_anti").isEmpty():
            return step.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = step
