"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import release, settle, size_of


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, within: int | None = None) -> DataFrame:
    """links (a, b) to one row (node, root) per node that has a link and is not the smallest of its component; root is the smallest.

    A hub costs no task more than its share: minima are pre-aggregated, and the joins that follow may be split by AQE.
    Self links and repeated links do no harm; no links: no rows. `within`: bytes that the links don't exceed, if known.
    """
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), within)
    size = size_of(edges)  # steps may double the links at most
    while True:
        # done when every node but the roots has one link, and that to a root
        many = edges.groupBy("a").count().where("count > 1").limit(1)
        chained = edges.select("a").join(edges.select(F.col("b").alias("a")), "a", "left_semi").limit(1)
        if many.isEmpty() and chained.isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, edges = edges, settle(_small_star(_large_star(edges)), 2 * size)
        release(before)
