"""Connected components of a table of links, as Spark joins: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiobank.sources.scratch import stage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    around = _both_ways(links)
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b: long): root is the smallest node that can be reached.

    Links from a node to itself and nulls are ignored. Every round is written to the scratch folder, so a lost
    executor costs one round. The number of rounds grows with the logarithm of the largest component.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    known = links.where("a <> b").select(a.alias("a"), b.alias("b")).distinct()
    links, mark = _staged(known)
    while mark[0]:
        links, after = _staged(_small_star(_large_star(links)))
        if after == mark:
            break
        mark = after
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _staged(links: DataFrame) -> tuple[DataFrame, tuple]:
    written = stage(links.select("a", "b"), "links")
    row = written.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40)).cast("long")).first()
    return written, tuple(row)
