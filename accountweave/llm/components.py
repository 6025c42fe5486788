"""Connected components of a table of links, by stars.

Links are turned until every node points at the least node of its component: first each node's larger neighbours are
linked to its least neighbour, then its smaller ones. Both steps are an aggregate and a join; nothing is gathered on a
node or on the driver. Each round is written to the shared folder, so lineage stays short and a lost executor costs a
re-read. The number of rounds grows with the logarithm of the size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountweave.llm.common import stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``a < b`` in every link: of each ``b`` the least ``a`` is the new end of the others."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    turned = links.join(least, "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return turned.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def _all_stars(links: DataFrame) -> bool:
    """Whether each ``b`` has one link and is the ``a`` of none: then each component is one star."""
    ends = links.select("b", F.lit(1).alias("n")).unionByName(links.select(F.col("a").alias("b"), F.lit(0).alias("n")))
    nodes = ends.groupBy("b").agg(F.sum("n").alias("n"), F.min("n").alias("least"))
    return nodes.where("n > 1 or n = 1 and least = 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links`` (``a, b``); a component is named by its least node."""
    now = stage(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars")
    while not _all_stars(now):
        now = stage(_small_star(_large_star(now)), "stars")
    nodes = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (of ``components``) after further ``links``; only components that these touch are worked out again."""
    name = found.select(F.col("node").alias("a"), F.col("component").alias("x"))
    other = found.select(F.col("node").alias("b"), F.col("component").alias("y"))
    ends = links.join(name, "a", "left").join(other, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    turned = stage(components(ends), "joined")
    renamed = found.join(turned.select(F.col("node").alias("component"), F.col("component").alias("new")), "component", "left")
    # The name of a component is one of its nodes, so what is not a node yet is new.
    fresh = turned.join(found.select("node"), "node", "left_anti")
    return renamed.select("node", F.coalesce("new", "component").alias("component")).unionByName(fresh.select("node", "component"))
