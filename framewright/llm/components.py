"""Connected components of a graph whose links are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import cut_lineage

#: A node's links are dealt over so many tasks, for one node may have most of them.
SALTS = 8
MAX_ROUNDS = 60


def _minima(links: DataFrame) -> DataFrame:
    """For each a the least b, once for every salt; minima are taken before the exchange."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    return least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _beside_minimum(links: DataFrame) -> DataFrame:
    return links.withColumn("salt", F.pmod("b", F.lit(SALTS)).cast("int")).join(_minima(links), ["a", "salt"])


def components(links: DataFrame) -> DataFrame:
    """links (a, b), two longs each, to (node, root): every node that has a link to another, and its component's least node.

    Alternates two steps until nothing changes: every node passes its least neighbour
    to the larger neighbours, then to the smaller ones. Each ends with fewer or
    shorter chains, so that the rounds grow with the logarithm of the longest chain.
    Each round is written to the shared folder; no links come to the driver.
    """
    links = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = cut_lineage(links)
    state = None
    for _ in range(MAX_ROUNDS):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _beside_minimum(both).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
        small = _beside_minimum(large)
        kept = small.select("a", F.col("least").alias("b"))
        moved = small.where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        links = cut_lineage(kept.union(moved).distinct())
        # The same set of links has the same count and sum of hashes.
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = tuple(now)
    raise RuntimeError(f"links had not settled after {MAX_ROUNDS} rounds")
