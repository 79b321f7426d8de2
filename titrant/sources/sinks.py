"""Sinks. Nothing is changed in place: every sink writes a new snapshot, and a lazy DataFrame is the dry run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rules import bench_notes, nested_profile
from .documents import write_documents
from .folders import written


def records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def profile_documents(applied: DataFrame) -> DataFrame:
    """``key`` and the profile's document as JSON, directives nested by group."""
    fired = F.transform("rules_fired", lambda r: F.struct(*[r[c].alias(c) for c in ("id", "because", "cite", "confidence", "field_consensus")]))
    doc = F.struct(F.col("name").alias("reagent_name"), "cas", nested_profile(F.col("profile")).alias("handling_profile"), fired.alias("rules_fired"), "conflicts")
    return applied.select("key", F.to_json(doc, {"ignoreNullFields": "false"}).alias("value"))


def profiles(applied: DataFrame, path: str) -> None:
    """``key`` and document as rows of JSON, in as many files as there are tasks, however many records there are."""
    profile_documents(applied).write.mode("overwrite").json(path)


def profile_files(applied: DataFrame, path: str) -> None:
    """One file for each record, many a task, committed together."""
    write_documents(written(profile_documents(applied), "documents"), path)


def mirrors(df: DataFrame, *paths: str) -> None:
    """The same snapshot in several places, computed once; what was there before goes."""
    df.write.mode("overwrite").json(paths[0])
    for path in paths[1:]:
        df.sparkSession.read.schema(df.schema).json(paths[0]).write.mode("overwrite").json(path)


def index(manifest: DataFrame, path: str) -> None:
    """The published index: its files, read in order of name, are one JSON array with the rows in their order.

    The rows keep the partitions of their sort, so no task holds them all.
    """
    lines = manifest.select(F.to_json(F.struct(*manifest.columns), {"ignoreNullFields": "false"}).alias("value"), F.monotonically_increasing_id().alias("place"))
    lines = written(lines, "index")
    ends = lines.agg(F.min("place").alias("first"), F.max("place").alias("last")).first()
    if ends.first is None:
        out = lines.sparkSession.createDataFrame([("[]",)], "value string")
    else:
        begin, end = F.when(F.col("place") == ends.first, "[").otherwise(","), F.when(F.col("place") == ends.last, "]").otherwise("")
        out = lines.orderBy("place").select(F.concat(begin, "value", end).alias("value"))
    out.write.mode("overwrite").text(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="")


def with_rule_notes(applied: DataFrame) -> DataFrame:
    """Records whose notes are the rules that fired."""
    return applied.withColumn("bench_knowledge", bench_notes(F.col("rules_fired"))).drop("striking_fact", "rules_fired", "profile", "conflicts")


def kept(df: DataFrame, verdicts: DataFrame, key: str = "slug") -> DataFrame:
    """The snapshot without what a verdict drops."""
    return df.join(verdicts.filter("verdict = 'drop'").select(key), key, "left_anti")


def cache(old: DataFrame, new: DataFrame, path: str) -> None:
    """A key-value table with later entries over earlier ones; a null value is a remembered miss."""
    both = old.withColumn("__o", F.lit(0)).unionByName(new.withColumn("__o", F.lit(1)))
    rest = [c for c in old.columns if c != "key"]
    top = both.groupBy("key").agg(F.max(F.struct("__o", *rest)).alias("t")).select("key", *[F.col(f"t.{c}").alias(c) for c in rest])
    top.write.mode("overwrite").parquet(path)
