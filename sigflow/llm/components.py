"""Connected components of a large, sparse graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of links (a, b: bigint), the component
    being its smallest node. Nulls and loops in the links are ignored.

    Each round points every node's larger neighbours, then its smaller ones,
    to the smallest, until only stars are left: O(log n) rounds, each a few
    joins on keys over the links. Only a link count and a checksum come to
    the driver.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = links.filter("a <> b").select(low.alias("a"), high.alias("b")).distinct()
    links = staged(links, "links")
    mark = None
    while True:
        links = staged(_small_star(_large_star(links)), "links")
        n, check = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, check) == mark:
            break
        mark = n, check
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("component")))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("least").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    others = links.join(least, "b").filter("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return least.select(F.col("least").alias("a"), "b").unionByName(others).distinct()
