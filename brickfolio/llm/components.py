"""Connected components of a link table, by alternating large and small stars (Kiveris et al., 2014).

Every step is a grouped minimum and a join; each round is written to the shared folder, so a lost executor costs one round. Only the
row count and a checksum of a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickfolio.llm.tables import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("low", "high")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("node", "least"))
    return both.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    return (links.join(least, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
            .union(least.select("high", F.col("least").alias("low"))).where("high != low").distinct())


def components(links: DataFrame) -> DataFrame:
    """links: two long columns. Returns node, root (the least node it is linked with, over any number of links) of all linked nodes."""
    a, b = links.columns
    now = stored(links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where("high != low").distinct(), "links")
    mark = None
    while True:
        now = stored(_small_star(_large_star(now)), "links")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if found == mark:
            return now.select(F.col("high").alias("node"), F.col("low").alias("root")).union(now.select("low", "low").distinct())
        mark = found
