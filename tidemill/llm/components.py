"""Connected components of a link table by alternating large and small stars, on Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import written


def _stars(links: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has that one neighbour alone: the roots are known then."""
    ends = F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )
    nodes = links.select(F.inline(ends)).groupBy("node").agg((F.sum("up") + F.max("down")).alias("n"))
    return (nodes.agg(F.max("n")).first()[0] or 0) <= 1


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node reachable.

    ``links`` has bigint columns u and v, u different from v. A round is two joins on narrow rows; the number of rounds
    grows with the logarithm of the longest chain. Each round is a written table; links that are stars need none.
    """
    now = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _stars(now):
        now = written(_small_star(_large_star(now)), "links")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
