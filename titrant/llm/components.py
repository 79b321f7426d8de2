"""Connected components of a table of links, by alternating large-star and small-star steps.

No step gathers a node's neighbours: each is a minimum by node and a join back, so a node with a third of all links is
split like any skewed join. After every round the links are written to the shared folder, which cuts their lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import released, settled


def _is_done(links: DataFrame) -> bool:
    """Whether every node either has one link, to a lesser node, or is one that links lead to."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: for every node of a link, the least node of its component. Self-links and nulls are dropped."""
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now = settled(now, "links")
    while not _is_done(now):
        # large star: u's larger neighbours point to the least of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settled(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = settled(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "links")
        released(now, least)
        # small star: u and its smaller neighbours point to the least of those
        least = settled(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = large.join(least, "u")
        now = settled(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links")
        released(large, least)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
