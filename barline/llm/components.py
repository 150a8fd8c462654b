"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barline.sources.tables import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for every node of ``links`` (``a``, ``b``).

    Each round links a node's neighbours to the smallest node it knows, first the
    larger neighbours, then the smaller ones. A node's links never meet in one
    group: the smallest neighbour is an aggregate that combines before the shuffle,
    and the join that hands it out splits skewed keys. Rounds grow with the
    logarithm of the longest chain; each is staged, which cuts the lineage.
    """
    edges = stage(links.select("a", "b").filter("a <> b").distinct(), "links")
    while True:
        stars = stage(_star(_star(edges, larger=True), larger=False), "links")
        if _same(edges, stars):
            break
        edges = stars
    members = stars.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return members.union(members.select(F.col("root").alias("node"), "root").distinct())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    if larger:
        both = edges.union(edges.select("b", "a"))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("root"))
    linked = both.join(least, "a")
    if larger:
        linked = linked.filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    else:
        linked = linked.select(F.col("b").alias("a"), F.col("root").alias("b")).union(
            least.select("a", F.col("root").alias("b"))
        )
    return linked.filter("a <> b").distinct()


def _same(before: DataFrame, after: DataFrame) -> bool:
    """Whether two sets of links are equal, by their count and the sum of their hashes."""
    mark = [F.count("*"), F.sum(F.xxhash64(F.greatest("a", "b"), F.least("a", "b")).cast("decimal(20,0)"))]
    return before.agg(*mark).first() == after.agg(*mark).first()
