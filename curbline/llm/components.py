"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node, written, and a join; a node with very many neighbours
is pre-aggregated by its minimum and its rows in the join are split by adaptive
execution, which can only do so where the join does not share its shuffle with the aggregate. Each round is a written table, so a lost executor costs one round.
Rounds end when every node has one parent that is no child itself: such stars
are the components, and a further round would return them unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import written


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _settled(stars: DataFrame) -> bool:
    """Whether every node points at one root; ``stars`` has distinct rows (u, v)."""
    roles = stars.select(F.col("u").alias("node"), F.lit(1).alias("parents"), F.lit(0).alias("root")).unionByName(
        stars.select(F.col("v").alias("node"), F.lit(0).alias("parents"), F.lit(1).alias("root")))
    open_nodes = roles.groupBy("node").agg(F.sum("parents").alias("parents"), F.max("root").alias("root"))
    return open_nodes.where("parents + root > 1").isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node.

    ``edges`` may repeat, point either way and hold loops; rows with a null end
    are ignored. No edges give an empty result.
    """
    ends = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    stars = written(ends.where("u <> v").distinct(), "edges")
    while not _settled(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(written(_lowest(both), "lowest"), "u").where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()
        large = written(large, "large-star")
        lowest = written(_lowest(large), "lowest")
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lowest.select("u", F.col("m").alias("v")))
        stars = written(small.where("u <> v").distinct(), "small-star")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
