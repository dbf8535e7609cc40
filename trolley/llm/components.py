"""Connected components of a link table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import materialise


def large_star(links: DataFrame) -> DataFrame:
    """Connect every node's larger neighbours to its smallest neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Connect every node and its smaller neighbours to the smallest of them. Links go from larger to smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    others = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def star_forest(links: DataFrame) -> DataFrame:
    """``(a, b)``: every linked node but the smallest of its component, with that smallest node.

    ``links`` has columns a and b in any direction; links of a node to itself are ignored. Each round is written to
    the shared folder; the number of rounds grows with the logarithm of the longest chain.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = materialise(links.select(a, b).where("a > b").distinct(), "links")
    before = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == before or not now[0]:
            return links
        before = now
        links = materialise(small_star(large_star(links)), "links")
