"""Similar names: pairs whose matching-blocks ratio is at least a threshold, without comparing all with all.

``ratio = 2 M / (la + lb)``, where ``M`` characters match in order. At a threshold ``t`` at most ``d = (1 - t)(la + lb)``
characters of both names don't, and each of them spoils at most one segment of a name that is cut into several. A name is
cut into up to ``3 (d + 1)`` segments, and the ``d + 1`` of them that the fewest names have are its keys: one of these
stands whole in every partner. So what all names begin with ("recombinant human") is nobody's key as long as the rest
has enough segments. With ``e`` of the ``d`` characters missing in a partner and ``i`` added, ``i - e`` is the difference of
lengths, so a segment has at most ``d + 1`` places where it may stand. Candidates are an equi-join of keys with
substrings, of which those too many edits apart go before any Python; only candidates are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.97


def spare(total: object, threshold: float):
    """The most characters of both names together that may not match, given their lengths' sum."""
    return F.floor(F.lit(1 - threshold) * total + F.lit(1e-9)).cast("int")


def _segments(rows: DataFrame, length: str, threshold: float) -> DataFrame:
    """Adds, for names of a length: ``least`` (how many keys such a name has) and, a row each, ``at`` and ``size`` of its segments."""
    longest = F.floor(F.col(length) * F.lit((2 - threshold) / threshold) + F.lit(1e-9)).cast("int")
    rows = rows.withColumn("least", spare(F.col(length) + longest, threshold) + 1).withColumn("k", F.least(3 * F.col("least"), F.col(length)))
    begin = lambda i: F.floor(i * F.col(length) / F.col("k")).cast("int")
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    return rows.withColumns({"at": begin(F.col("i")), "size": begin(F.col("i") + 1) - begin(F.col("i"))}).drop("k", "i")


def candidates(names: DataFrame, name: str = "name", threshold: float = THRESHOLD) -> DataFrame:
    """Distinct pairs ``a < b`` of distinct names that can reach the threshold."""
    base = names.select(F.col(name).alias("s")).filter("s IS NOT NULL AND s <> ''").distinct().withColumn("l", F.length("s"))
    seg = _segments(base.select(F.col("s").alias("x"), F.col("l").alias("lx")), "lx", threshold)
    seg = seg.select("x", "lx", "least", "at", F.substring(F.col("x"), F.col("at") + 1, F.col("size")).alias("part"))
    common = seg.groupBy("lx", "at", "part").agg(F.count("*").alias("n"))
    # a name's keys are gathered by name: a few dozen segments at most for each
    keys = seg.join(common, ["lx", "at", "part"]).groupBy("x", "lx", "least").agg(F.array_sort(F.collect_list(F.struct("n", "at", "part"))).alias("keys"))
    keys = keys.select("x", "lx", F.explode(F.slice("keys", F.lit(1), F.col("least"))).alias("key")).select("x", "lx", "key.at", "key.part")
    # every partner length, every segment of a name of that length, every place where it may stand
    shortest = F.ceil(F.col("l") * F.lit(threshold / (2 - threshold)) - F.lit(1e-9)).cast("int")
    longest = F.floor(F.col("l") * F.lit((2 - threshold) / threshold) + F.lit(1e-9)).cast("int")
    probe = base.select(F.col("s").alias("y"), F.col("l").alias("ly"), F.explode(F.sequence(F.greatest(shortest, F.lit(1)), longest)).alias("lx"))
    probe = _segments(probe, "lx", threshold).withColumn("d", spare(F.col("lx") + F.col("ly"), threshold)).withColumn("more", F.col("ly") - F.col("lx"))
    fewer, further = F.floor((F.col("d") - F.col("more")) / 2).cast("int"), F.floor((F.col("d") + F.col("more")) / 2).cast("int")
    probe = probe.filter(F.abs("more") <= F.col("d")).withColumn("p", F.explode(F.sequence(F.greatest(F.col("at") - fewer, F.lit(0)), F.greatest(F.col("at") + further, F.lit(0))))).filter("p + size <= ly")
    probe = probe.select("y", "lx", "at", F.substring(F.col("y"), F.col("p") + 1, F.col("size")).alias("part")).distinct()
    pairs = keys.join(probe, ["lx", "at", "part"]).filter("x <> y")
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), spare(F.col("lx") + F.length("y"), threshold).alias("d"))
    # no more edits than characters without a match; the distance ends where it exceeds them
    return pairs.filter(F.expr("levenshtein(a, b, d) >= 0")).select("a", "b").distinct()


def similar_pairs(names: DataFrame, name: str = "name", threshold: float = THRESHOLD) -> DataFrame:
    """``a, b, ratio`` of names whose ratio, with the lesser name first, reaches the threshold."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher, held = SequenceMatcher(None), None
        for pdf in batches:
            ratios = []
            for a, b in zip(pdf["a"], pdf["b"], strict=True):
                if b != held:  # what is prepared for the second name serves all that are held against it
                    matcher.set_seq2(b)
                    held = b
                matcher.set_seq1(a)
                ratios.append(matcher.ratio() if matcher.real_quick_ratio() >= threshold and matcher.quick_ratio() >= threshold else 0.0)
            pdf["ratio"] = ratios
            yield pdf[pdf["ratio"] >= threshold]

    return candidates(names, name, threshold).sortWithinPartitions("b").mapInPandas(compare, "a string, b string, ratio double")


def without_pairs(pairs: DataFrame, forbidden: DataFrame) -> DataFrame:
    """``pairs`` less the unordered pairs ``a, b`` of a table."""
    return pairs.join(forbidden.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b"), ["a", "b"], "left_anti")
