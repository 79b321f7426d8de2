"""A cache that outgrows whole rewrites: a key-value table in hash buckets, of which an upsert rewrites only those that change.

A key's bucket is a folder, so an upsert reads the folders of its keys and no others, and a bucket in which every new entry
is there already stays as it is. A null value is a remembered miss, and an entry like any other. The number of buckets is part of the
folders' names and stays what it was at first; choose it so that a bucket is a task's work.

What a bucket is to become is written beside the table before anything is replaced, so a lost executor costs no entry, and
new files take the old ones' places only when all are there. Whoever reads meanwhile may see some buckets before and some
after; two upserts at a time aren't for one table. A driver that dies while folders change places can leave a bucket without
its old files and the new ones in the table's staging folder.

Edge cases: of equal keys in one upsert the greatest row counts (null values least); a null key is a key. No entries change
nothing, and make no table. Entries must have the table's columns, in any order; any but ``__bucket`` may be among them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .folders import released, written

BUCKETS = 256
BUCKET = "__bucket"


def _bucket(key: Column, n: int) -> Column:
    return F.concat(F.pmod(F.xxhash64(key), F.lit(n)).cast("string"), F.lit(f"of{n}"))


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def entries(spark: SparkSession, path: str) -> DataFrame:
    """All entries of the cache."""
    return spark.read.parquet(path).drop(BUCKET)


def _among(df: DataFrame) -> list[str]:
    """The buckets that occur: never more than the table has."""
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())


def _replace(rows: DataFrame, path: str) -> None:
    rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def upsert(new: DataFrame, path: str, key: str = "key", buckets: int = BUCKETS) -> Sequence[str]:
    """Put ``new`` entries over what the cache at ``path`` has; the buckets that were rewritten."""
    spark = new.sparkSession
    col = lambda c, of="": F.col(f"{of}`{c}`")
    rest = [c for c in new.columns if c != key]
    old = _table(spark, path)
    if old is not None:
        buckets = int(old.select(BUCKET).first()[0].partition("of")[2])
    top = new.groupBy(col(key)).agg(F.max(F.struct(*[col(c).alias(c) for c in rest])).alias("__top"))
    latest = written(top.select(_bucket(col(key), buckets).alias(BUCKET), col(key), *[col(c, "__top.").alias(c) for c in rest]), "latest")
    if old is None:
        touched = _among(latest)
        if touched:
            _replace(latest, path)
        released(latest)
        return touched
    names = [BUCKET, key, *rest]
    at = old.filter(F.col(BUCKET).isin(_among(latest))).select(*map(col, names))
    # a row that the cache has as it is changes nothing; null is equal to null
    same = [col(c, "n.").eqNullSafe(col(c, "o.")) for c in names]
    fresh = written(latest.alias("n").join(at.alias("o"), same, "left_anti"), "fresh")
    touched = _among(fresh)
    if touched:
        stays = at.filter(F.col(BUCKET).isin(touched)).alias("o").join(fresh.alias("n"), [col(c, "o.").eqNullSafe(col(c, "n.")) for c in (BUCKET, key)], "left_anti")
        merged = written(stays.unionByName(fresh), "merged")
        _replace(merged, path)
        released(merged)
    released(latest, fresh)
    return touched
