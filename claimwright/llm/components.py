"""Connected components of a link table, as label stars; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import stored


def _least_of(links: DataFrame) -> DataFrame:
    """Least neighbour of each left node; partial minima, so a node with a third of all links is one row per task."""
    return links.groupBy("a").agg(F.min("b").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """node, root: the least node of each component, for every node that has a link.

    Alternating large and small stars: each round hooks neighbours to the least node seen, halving the
    distances, until every node is linked to its root alone. links: (a, b), in either direction.
    """
    stars = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least_of(both).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "large")
        least = _least_of(large)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        stars = stored(small.distinct(), "stars")
        now = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
