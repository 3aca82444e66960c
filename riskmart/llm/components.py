"""Connected components of links, with Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for every node of ``links`` (a, b).

    Alternating large-star and small-star rounds: every round is a grouping and a join on
    the links, whose number never grows; the number of rounds is logarithmic in the
    longest path in practice. Each round is written to the shared folder.
    """
    edges = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = (
            both.where(F.col("b") > F.col("a")).join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        large = stored(large.where(F.col("a") != F.col("b")).distinct(), "large-star")
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where(
            F.col("a") != F.col("b")
        ).unionByName(down.select("a", F.col("low").alias("b")))
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = stored(small.where(F.col("a") != F.col("b")).distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root"))
    return roots.select(F.col("a").alias("node"), "root").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct()
    )
