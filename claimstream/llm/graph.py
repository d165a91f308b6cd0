"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimstream.llm.common import cut


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every linked node; a component is named by its smallest node.

    Alternates two steps (Kiveris et al., "Connected Components in MapReduce and Beyond",
    2014): hang larger neighbours, then smaller ones, on the smallest neighbour, until the
    links are stars.  The joins send one row per node to the links of that node, so a
    hub is a skewed join whose links can be split over tasks.
    """

    def digest(edges: DataFrame) -> tuple:
        return tuple(
            edges.agg(
                F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
            ).first()
        )

    edges = cut(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    )
    seen = digest(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = cut(large.distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        now = digest(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
