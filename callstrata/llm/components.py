"""Connected components of a table of links, with a bounded number of rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of `links` (a, b).

    Alternates two steps until nothing changes: every node links its larger
    neighbours to its smallest one, then its smaller ones. Stars stay as they are and
    paths halve, so the rounds grow with the logarithm of the longest path. Each round's
    links are stored. Links of a node to itself and repeated ones do no harm."""
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .filter("a != b").distinct(), "links")
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").filter("b > a AND b != m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
                         .alias("a"), F.col("m").alias("b")).filter("a != b").distinct())
        edges = written(small, "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                        ).first()
        if now == state:
            break
        state = now
    found = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return written(found.unionByName(roots), "components")
