"""Article texts by id: what the cache has is kept, the rest is asked for, and only whole articles are written."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookups import fetch_status, pending
from ..operators.services import valid_articles
from ..operators.tables import is_article
from .folders import written
from .search import transport

Get = Callable[[str], tuple[int, bytes]]  # id in, status and body out
CACHE = "pmcid string, xml binary"


def article(get: Get, pmcid: str, tries: int = 3, wait: Callable[[float], None] = time.sleep) -> bytes | None:
    """The article, or None. A 404 is final; server errors and bodies that are no article are tried again, twice as long apart each time."""
    for attempt in range(1, tries + 1):
        status, body = get(pmcid)
        if status == 200 and is_article(body):
            return body
        if status != 200 and status < 500:
            return None
        if attempt < tries:
            wait(2.0**attempt)
    return None


def cached(spark: SparkSession, cache: str) -> DataFrame:
    """``pmcid, xml`` of the cache that aren't empty; an absent cache is an empty one."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], CACHE)
    return spark.read.schema(CACHE).parquet(cache).filter("length(xml) > 0")


def fetch(ids: DataFrame, cache: str, get: str, wait: float = 1.0) -> DataFrame:
    """``pmcid, status`` (cached, ok or miss) of every id. ``get`` names the transport (``module:function``); ``wait`` scales the pauses between attempts.

    Bodies go from the tasks that fetched them straight into the cache, as new files beside the old; none goes to the driver.
    """
    spark = ids.sparkSession
    asked = ids.select("pmcid").filter("pmcid IS NOT NULL").distinct()
    known = written(cached(spark, cache).select("pmcid").distinct(), "cached")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = transport(get)
        for pdf in batches:
            bodies = [article(ask, p, wait=lambda s: time.sleep(s * wait)) for p in pdf["pmcid"]]
            yield pd.DataFrame({"pmcid": pdf["pmcid"], "xml": pd.Series(bodies, dtype=object)}).dropna()

    pending(asked, known, "pmcid").mapInPandas(run, CACHE).write.mode("append").parquet(cache)
    have = cached(spark, cache).select("pmcid", F.lit(True).alias("there")).distinct()
    out = asked.join(have, "pmcid", "left").join(known.withColumn("before", F.lit(True)), "pmcid", "left")
    return out.select("pmcid", fetch_status(F.col("there"), F.col("before")).alias("status"))


def sweep(spark: SparkSession, cache: str, into: str) -> DataFrame:
    """A new snapshot of the cache without what is no whole article; one row ``n_valid, n_removed``."""
    rows = spark.read.schema(CACHE).parquet(cache)
    judged = written(valid_articles(rows), "judged")
    rows.join(judged.filter("valid").select("pmcid"), "pmcid", "left_semi").write.mode("overwrite").parquet(into)
    return judged.agg(F.count_if("valid").alias("n_valid"), F.count_if(~F.col("valid")).alias("n_removed"))
