"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm.common import discard, saved


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """One step: every neighbour of a node (only smaller ones if ``small``) links to the node's smallest neighbour.

    Links are (a, b) with a > b. The minimum is combined before its shuffle, and
    it joins back to the links, so a node with a third of all links is split.
    """
    if small:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        moved = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``links`` (columns a, b of one orderable type); root is the smallest node reachable.

    Each round is written to the shared folder. Rounds grow with the logarithm
    of the number of nodes; the last one changes nothing. Self-links count for
    nothing, and a table without links gives no rows.
    """
    now = saved(spark, links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(mark) == before or not mark[0]:
            break
        before = tuple(mark)
        after = saved(spark, _stars(_stars(now, small=False), small=True), "links")
        discard(spark, now)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
