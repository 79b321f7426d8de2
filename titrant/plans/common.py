"""What registered queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
Entry = tuple[Query, str | None]
#: So many rows a task gets, about, where each row is much work.
PER_TASK = 5_000
#: So many rows, where a task keeps them for a sort or an aggregation.
HELD = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str, per_task: int = PER_TASK, like: DataFrame | None = None) -> DataFrame:
    """Rows dealt over tasks by their number: a file of few bytes is few splits, and a shuffle of few bytes few tasks, however much work or memory each row is.

    ``like``: a table with as many rows, where counting those of ``df`` is more than counting a table's.
    """
    tasks = -(-(df if like is None else like).count() // per_task)
    return df.repartition(tasks, key) if tasks > 1 else df


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A literal table, the same on both sides of a comparison."""
    return spark.createDataFrame(rows, schema)


def times(df: DataFrame, rows: list[tuple], **kinds: str) -> DataFrame:
    """Every row of ``df`` with each of a few literal ones, without a join."""
    items = [F.struct(*[F.lit(v).cast(k).alias(n) for v, (n, k) in zip(r, kinds.items(), strict=True)]) for r in rows]
    return df.select("*", F.inline(F.array(*items)))


def quoted(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, float):
        return repr(value) if "e" in repr(value) else f"{value!r}e0"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def sql_values(rows: list[tuple], name: str, columns: str) -> str:
    return f"{name}({columns}) AS (VALUES {', '.join('(' + ', '.join(map(quoted, r)) + ')' for r in rows)})"
