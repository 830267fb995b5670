"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; root is the smallest node it reaches.

    ``links`` has long columns a and b. Each round links every larger neighbour of a
    node to its smallest neighbour, then does the same among smaller neighbours;
    the number of rounds grows with the logarithm of the longest chain. Smallest
    neighbours are pre-aggregated and stored, so a node with very many links is
    joined by files that Spark can split.
    """
    links = stored(_down(links), "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), "lows")
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = stored(_down(large), "links")
        low = stored(links.groupBy("a").agg(F.min("b").alias("low")), "lows")
        small = links.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = stored(_down(small.union(low)), "links")
        before, state = state, links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _down(links: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller node."""
    return (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a > b")
        .distinct()
    )
