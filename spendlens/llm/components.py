"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import kept


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Every linked node with the smallest node it can reach: columns ``node``, ``component``.

    Links may repeat, may join a node with itself, and have no direction; null ends are ignored. No links give no
    rows. Each round moves all links of a node to its smallest neighbour, once towards larger and once towards
    smaller nodes, until the links are stars; chains shorten by half or more in each round. A round is a table in
    the shared folder, and only its size and checksum reach the driver.
    """
    edges = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u != v")
    edges = kept(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        upward = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        upward = upward.where("u != v").distinct()
        lowest = upward.groupBy("u").agg(F.min("v").alias("m"))
        moved = upward.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = kept(moved.union(lowest.select("u", F.col("m").alias("v"))).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
