"""Connected components of links between 64-bit keys, by rounds of star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(key, root): of each linked key, the least key of its component.

    Each round hangs larger neighbours of a key, then smaller ones, on the least neighbour; links stay no more
    than they were and end as stars in a number of rounds that grows with the logarithm of the longest chain.
    Every round is written to the shared folder.
    """
    links = stored(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("key"), F.col("b").alias("root"))
    before = None
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct().select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.select(F.col("a").alias("k"), "m"), F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stored(small.where(F.col("a") != F.col("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("a").alias("key"), F.col("b").alias("root"))
        before = now
    raise RuntimeError(f"components have not settled in {most_rounds} rounds")
