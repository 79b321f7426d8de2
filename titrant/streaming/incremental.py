"""Incremental ingest: new files become evidence rows exactly once, with nothing kept running. Beyond the batch operators."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Batches(Protocol):
    """Work on whole increments by number, which writes its rows to folders ``increment=<number>`` of the target; repeated with a number, it replaces what it wrote for it."""

    schema: str

    def __call__(self, spark: SparkSession, rows: DataFrame, number: int, target: str, kept: str) -> None: ...


def ingest(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] | Batches, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """Everything in ``source`` that ``checkpoint`` hasn't seen goes through ``work`` (without state, or with state that emits by appending; or with increments taken whole) into ``target``; what is there now is returned."""
    stream = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(source)
    if hasattr(work, "schema"):
        # in the caller's session: the stream's own has no adaptive plans
        query = stream.writeStream.foreachBatch(lambda rows, number: work(spark, rows, number, target, f"{checkpoint}-kept")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        try:
            return spark.read.schema(f"{work.schema}, increment int").parquet(target).drop("increment")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], work.schema)  # nothing has come yet
    query = work(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(target)


def windowed_counts(events: DataFrame, time: str = "ts", by: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their values by window and kind; a stream forgets windows that its watermark has passed."""
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late) if events.isStreaming else events
    out = rows.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n_events"), F.sum("value").alias("total_value"))
    return out.select(F.col("w.start").alias("window_start"), by, "n_events", "total_value")


def first_seen(events: DataFrame, keys: list[str], time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Each key once; a stream keeps keys for as long as its watermark lets late ones come. Times without a zone are the session's."""
    if not events.isStreaming:
        return events.dropDuplicates(keys)
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
