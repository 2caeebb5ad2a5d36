"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.tables import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour instead."""
    both = links.select("src", "dst").unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("least"))
    return both.filter("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, are linked to the smallest of them."""
    down = links.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("least"))
    moved = down.join(least, "src").filter("dst != least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    return moved.unionByName(least.select("src", F.col("least").alias("dst")))


def _are_stars(links: DataFrame) -> bool:
    """Whether each node that points anywhere points to one node, which points nowhere; links are distinct, src > dst."""
    up = links.select(F.col("src").alias("node"), F.lit(1).alias("points"), F.lit(False).alias("met"))
    down = links.select(F.col("dst").alias("node"), F.lit(0).alias("points"), F.lit(True).alias("met"))
    ends = up.unionByName(down).groupBy("node").agg(F.sum("points").alias("points"), F.max("met").alias("met"))
    return ends.filter("points > 1 OR points = 1 AND met").agg(F.count("*")).first()[0] == 0


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes with a link; links are (src long, dst long) in either direction.

    Links of a node to itself count for nothing; a table without links gives an empty one. Each round is a few
    aggregations and joins whose hot side has one row per node; links and labels stay on the executors. The rounds end
    when every component is a star, which one aggregation tells: stars take no round at all.
    """
    now = stored(links.filter("src != dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    while not _are_stars(now):
        now = stored(_small_star(_large_star(now)).distinct())
    tops = now.select(F.col("dst").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(tops)
