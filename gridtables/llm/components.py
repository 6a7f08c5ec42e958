"""Connected components of a table of links, by alternating large and small stars.

Each step replaces links by links to the smallest neighbour; a node with many neighbours is met by a minimum (combined before the
shuffle) and a join whose crowded side adaptive execution splits. Every round is staged, so no plan grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtables.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``links`` has a and b (long). Gives node and root (the smallest node reachable) for every node that has a link and is no root."""
    edges = staged(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        edges = staged(small)
        # the sums change whenever a link does: links only ever move to smaller nodes
        state = edges.agg(F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
