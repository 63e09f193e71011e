"""Connected components of a graph of links, by alternating star rounds.

A large-star round links every larger neighbour of a node to the smallest node
near it; a small-star round does the same with the smaller neighbours. Rounds
keep what is connected, and end when every component is a star: no node has two
links to smaller ones, or one to a node with such a link itself. Then each is
linked to the smallest of its component. A round is joins and aggregates over
the links, written to the shared folder; the driver sees a yes or no only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.staging import staged


def _near(links: DataFrame) -> DataFrame:
    """The smallest neighbour of each node. Written, so that the join with it can be split at a hot node."""
    return staged(links.groupBy("u").agg(F.min("v").alias("m")), "near")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    joined = both.join(_near(both), "u").select("u", "v", F.least("u", "m").alias("m"))
    return joined.where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
    near = _near(down)
    joined = down.join(near, "u")
    star = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return star.union(near.select("u", F.col("m").alias("v"))).distinct()


def _all_stars(links: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or one and a larger neighbour too."""
    up, down = (links.select(F.col(end).alias("node"), F.lit(n).alias("smaller"), F.lit(1 - n).alias("larger")) for end, n in (("u", 1), ("v", 0)))
    ends = up.union(down).groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return ends.where((F.col("smaller") > 1) | ((F.col("smaller") > 0) & (F.col("larger") > 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for every node of the links (u, v) but the roots."""
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    links = staged(links, "links")
    while not _all_stars(links):
        links = staged(_small_star(staged(_large_star(links), "large-star")), "small-star")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
