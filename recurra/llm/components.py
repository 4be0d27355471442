"""Connected components of links, by alternating large-star and small-star steps.

Each step moves links towards the smallest node of a neighbourhood (Kiveris et al., "Connected
Components in MapReduce and Beyond"), until each component is a star around its smallest node.
A neighbourhood is never collected: its smallest node is an aggregate, joined back. A step gives
at most a row per link and node, so only its result is freed of repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recurra.llm.common import SMALL_ROWS
from recurra.session import stage


def _least(links: DataFrame, few: bool) -> DataFrame:
    """Rows (a, m): the smallest neighbour of each node, to be broadcast if they are few."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return F.broadcast(least) if few else least


def _large_star(links: DataFrame, few: bool) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    moved = both.join(_least(both, few), "a").where("b > a")
    return moved.select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(links: DataFrame, few: bool) -> DataFrame:
    """``links`` with the larger node as a."""
    least = _least(links, few)
    moved = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether each larger node a has one link and is no centre; then no step moves a link."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("links")).union(
        links.select("b", F.lit(0)).distinct()
    )
    sides = ends.groupBy("node").agg(F.sum("links").alias("links"), F.count(F.lit(1)).alias("n"))
    return sides.where("links > 0 AND n > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) rows (node, group) of all linked nodes; a group's name is its least node.

    Links from a node to itself and repeated ones change nothing; no links give no rows.
    """
    known = stage(
        links.where("a != b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        "components",
    )
    # As many nodes as twice the links at most, here and after the large star.
    while rows := known.count():
        if _are_stars(known):
            break
        few = 2 * rows <= SMALL_ROWS
        known = stage(_small_star(_large_star(known, few), few), "components")
    stars = known.select(F.col("a").alias("node"), F.col("b").alias("group"))
    return stars.union(known.select(F.col("b").alias("node"), F.col("b").alias("group")).distinct())
