"""Connected components of a graph of links, by alternating large-star and small-star steps.

Each step reduces a node's neighbours to their smallest id before the join back, so a hub sends one row per task, and Spark
splits the hub's side of the join.  The links of each round are a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import written


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31))).first())


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    # The key is computed anew, so the sums are shuffled for the join and Spark can split the links of a hub.
    key = least.select(F.bitwise_not("a").alias("_key"), "low")
    return links.join(key, F.bitwise_not("a") == F.col("_key")).drop("_key")


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` of every node that has a link, from links ``a, b``; a component is named by its smallest node."""
    links = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before, now = None, _fingerprint(links)
    while before != now:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        large = _with_least(both, least).withColumn("low", F.least("a", "low")).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = _with_least(large, least).select(F.explode(F.array(
            F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b"))
        )).alias("e")).select("e.a", "e.b")
        links = written(small.where("a <> b").distinct(), "links")
        before, now = now, _fingerprint(links)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
