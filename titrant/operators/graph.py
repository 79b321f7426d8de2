"""Clusters of a table of pairs, by contraction.

In every round each node moves onto the neighbour, or stays on itself, whose hash of this round is least; on even rounds a
node with one neighbour always moves onto it. The links between what is left make the next, smaller graph: half of a chain's
nodes go in a round, all of a star's but two at once. When no link is left, the moves are played back from the last round
to the first, and each cluster takes the name of its least node.

A round is one minimum by node, aggregated on the map side first, and two joins with one row a node, so a node with a third
of all links is never gathered. Sizes shrink geometrically, so all rounds together cost a constant times the first. Each
round's links go as soon as the next ones are written; its moves stay until they are played back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.folders import released, written


def clusters(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``node, cluster``: the least node of each connected cluster. Pairs of a node with itself, or with null, are no links."""
    ends = pairs.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    links = written(ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    moves: list[DataFrame] = []
    while not links.isEmpty():
        mark = lambda c, k=len(moves): F.struct(F.xxhash64(F.lit(k), c).alias("h"), F.col(c).alias("to"))
        least = links.groupBy("u").agg(F.min(mark("v")).alias("m"), F.count("*").alias("n"))
        # on even rounds only: two nodes that are each other's one neighbour would change places for ever
        leaf = (F.col("n") == 1) & F.lit(len(moves) % 2 == 0)
        least = least.select("u", F.when(leaf, F.col("m.to")).otherwise(F.least("m", mark("u"))["to"]).alias("to"))
        moved = written(least, "moves")
        first = links.join(moved, "u").select("v", F.col("to").alias("u"))
        both = first.join(moved.select(F.col("u").alias("v"), "to"), "v").select("u", F.col("to").alias("v")).filter("u <> v")
        further = written(both.distinct(), "links")
        released(links)
        moves.append(moved)
        links = further
    released(links)
    if not moves:
        return pairs.select(F.col(a).alias("node"), F.col(a).alias("cluster")).limit(0)
    roots = moves.pop()
    while moves:
        moved = moves.pop()
        onward = roots.select(F.col("u").alias("to"), F.col("to").alias("root"))
        before, roots = roots, written(moved.join(onward, "to", "left").select("u", F.coalesce("root", "to").alias("to")), "roots")
        released(moved, before)
    names = roots.groupBy("to").agg(F.min("u").alias("cluster"))
    return roots.join(names, "to").select(F.col("u").alias("node"), "cluster")
