"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layercake.llm.common import settle


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node of ``links`` (``a``, ``b``).

    Large-star and small-star steps in turn (Kiveris et al. 2014): each hangs the neighbours of a node
    below its smallest neighbour, until nothing changes; the number of rounds grows with the logarithm
    of the longest path. Every round is written to the shared folder; the driver sees two numbers per
    round. Links with a null end, self links and repeated links are ignored. Minima are combined before the
    shuffle and joined back, so a node with very many links is split like any skewed join key.
    """
    links = _settled(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"),
                                  (F.col("a").isNotNull() & F.col("b").isNotNull()).alias("whole"))
                     .filter("whole").select("u", "v"))
    state = None
    while state != (now := _fingerprint(links)):
        state = now
        links = _settled(_small_star(_large_star(links)))
    below = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return below.union(roots.distinct())


def _settled(links: DataFrame) -> DataFrame:
    return settle(links.filter("u <> v").distinct(), "links")


def _fingerprint(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
    return int(row[0]), int(row[1])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    # All links point from the larger to the smaller node here.
    links = links.filter("u <> v").distinct()
    lowest = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", F.col("m").alias("v")))
