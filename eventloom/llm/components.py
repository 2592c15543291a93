"""Connected components by alternating large-star and small-star.

Each step is one aggregation (the smallest neighbour of each node, combined
before the shuffle) and one join, so no neighbourhood is ever gathered in a task.
Links and components stay distributed; the driver learns one bit per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.staging import stage


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link down, or only links up: then each component is a star."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("down")).distinct()
    )
    seen = ends.groupBy("node").agg(F.sum("down").alias("down"), F.count(F.lit(1)).alias("n"))
    # A member is here once, as the end of its link; a centre once, without a link down.
    return seen.where("n > 1").isEmpty()


def _star(around: DataFrame, moved: DataFrame) -> DataFrame:
    """Links of ``moved`` (node, b) handed on to the smallest node around ``node``.

    The minima are staged first: then both sides of the join are plain
    exchanges, and adaptive execution can split the rows of a hub.
    """
    least = around.groupBy("node").agg(F.min("b").alias("m"))
    least = stage(least.select("node", F.least("node", "m").alias("m")), "star")
    return (
        moved.join(least, "node")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b).

    ``component`` is the smallest node that can be reached. Direction, repeated
    links and self-links do not matter, but a node with only a self-link is in
    the result; links with a null end are left out. No links give no rows.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).dropna()
    alone = links.where("a = b").select(F.col("a").alias("node"))
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(links.distinct(), "links")
    while not _settled(links):
        # Large star: neighbours above a node go to the smallest around it.
        down = links.select(F.col("a").alias("node"), "b")
        up = links.select(F.col("b").alias("node"), F.col("a").alias("b"))
        links = stage(_star(down.unionByName(up), up), "large")
        # Small star: neighbours below a node, and the node, go to the smallest of them.
        down = links.select(F.col("a").alias("node"), "b")
        self_ = links.select(F.col("a").alias("node"), F.col("a").alias("b"))
        links = stage(_star(down, down.unionByName(self_.distinct())), "small")
    members = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    alone = alone.select("node", F.col("node").alias("component"))
    # A node that only links to itself may also be a member: its component is the smallest.
    found = members.unionByName(roots).unionByName(alone)
    return found.groupBy("node").agg(F.min("component").alias("component"))
