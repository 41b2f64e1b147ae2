"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mainspool.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)`` other than the roots themselves.

    The root is the smallest node reachable. Each round points a node's larger neighbours,
    then its smaller ones, at its smallest neighbour; the number of links never grows, and
    rounds grow with the logarithm of the longest path. Minima are taken with map-side
    combination and joined back from a written table, so that a hub's links stay a plain
    skewed join, which Spark splits. Self links and repeats are ignored; no links, no rows.
    """
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("k"), F.least("u", "v").alias("m")))
        large = materialise(both.join(least, both.u == least.k).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k"))
        small = large.join(least, large.u == least.k).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = materialise(small.where("u > v").distinct())
