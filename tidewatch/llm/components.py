"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import drop_table, table


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a``, ``b``); the component is its smallest node.

    Alternates two steps until nothing changes: every node hands its larger neighbours to the smallest one it
    knows, then its smaller ones. Links only ever get closer to the smallest node, and a round costs two
    aggregates with map-side combine and two joins. A hub's links are split by Spark's skew join. Only the
    number of links and a sum of their hashes reach the driver.
    """

    def ordered(df: DataFrame, a: str, b: str) -> DataFrame:
        return df.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()

    edges = table(ordered(links, "a", "b"), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == seen or not state.n:
            break
        seen = tuple(state)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        first = table(large, "links")
        least = first.groupBy("u").agg(F.min("v").alias("m"))
        moved = first.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = table(moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "links")
        drop_table(first)
        drop_table(edges)
        edges = small
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
