"""Connected components of a table of links, by alternating star contractions.

Every round hangs the larger neighbours of a node on its smallest one (large star), then the
smaller ones (small star), as published by Kiveris et al., "Connected Components in MapReduce and
Beyond" (2014). Each round is a grouping and a join, stored before the next, so lost executors cost
at most one round; only two numbers come to the driver to see whether anything changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.session import shared_root


def _hung(links: DataFrame, least: DataFrame) -> DataFrame:
    return links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _hung(both.filter("b > a"), least).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return _hung(down.filter("b < a"), least).unionByName(
        least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _seen(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every linked node that isn't the smallest of its component, the root.

    Links have no direction; repeated links, links of a node to itself and nulls are without effect.
    """
    shared_root(links.sparkSession)
    links = (links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
             .distinct().checkpoint())
    before, now = None, _seen(links)
    while now != before:
        links = _small_star(_large_star(links)).checkpoint()
        before, now = now, _seen(links)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
