"""Incremental fusion of evidence: a flag's confidence, said again each time it changes.

Sources of evidence (``key, flag, type, ref, agrees, ord``) come in as a stream. A flag's sources are kept in a state map, one
entry each, so that no task ever holds all sources of a flag; beside it stands a fixed-size summary. Of rows with the same
type and reference the one with the least ``ord`` counts (at equal ``ord`` the one that agrees), whenever it arrives: any
split of the evidence into increments ends with what one batch run over all of it gives.

Repeats of a source are combined before the shuffle, in each Arrow batch, so a source that is named a billion times doesn't
burden its flag's task. Rows of one flag meet in one task, and pass through it.

Edge cases: null ``agrees`` counts as agreement, null ``ord`` comes after every other, null types and references are values
like any other. Sources of unknown types and inherited ones count as sources, but decide nothing. Further columns are
left out. An empty stream says nothing.

Two ways give the same changes. ``confidence_changes`` is an operator of a stream, for any sink; each flag of an increment
is a call of Python and some messages to the state's server. ``Increments`` takes whole increments with Spark's own joins and
aggregations, for :func:`titrant.streaming.incremental.ingest`: what an increment says of its sources is appended to the
kept ones, every ``WHOLE``-th time all sources are written anew, and only flags that an increment names are fused again. It
reads the kept sources once an increment, so increments should be large.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.evidence import tier
from ..operators.lookups import one_per_key
from ..sources.folders import released, written

CHANGES = "key string, flag string, confidence string, n_sources long, change long"
_ROWS = "key string, flag string, type string, ref string, agrees boolean, ord long, tier string"
_LAST = 2**63 - 1
_SOURCE, _FLAG = ("key", "flag", "type", "ref"), ("key", "flag")
_KEPT = "key string, flag string, type string, ref string, best struct<ord: long, no: boolean>, increment int"
#: After so many increments the kept sources are written whole.
WHOLE = 16
#: What keeps state on a cluster's disks instead of its heaps; a map in the state needs it.
PROVIDER = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield rows.sort_values(["ord", "agrees"], ascending=[True, False], kind="stable").drop_duplicates(["key", "flag", "type", "ref"])


def _verdict(high_yes: int, high_no: int, medium_yes: int) -> str:
    if high_yes:
        return "medium" if high_no else "high"
    return "medium" if medium_yes and not high_no else "low"


class FlagConfidence(StatefulProcessor):
    """Keeps a flag's sources and what they amount to; a row for each change of the confidence."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sources = handle.getMapState("sources", "type string, ref string", "agrees boolean, ord long")
        self.summary = handle.getValueState("summary", "high_yes long, high_no long, medium_yes long, n_sources long, change long, confidence string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        old = self.summary.get()
        counts = {"high_yes": 0, "high_no": 0, "medium_yes": 0}
        n, change, before = 0, 0, None
        if old is not None:
            counts = dict(zip(counts, old[:3], strict=True))
            n, change, before = old[3:]

        def count(level: str | None, agrees: bool, by: int) -> None:
            place = f"{level}_{'yes' if agrees else 'no'}"
            if place in counts:
                counts[place] += by

        fresh = old is None  # no source is known yet, so none is asked for: each question is a message to the state's server
        for part in rows:
            best: dict[tuple, tuple] = {}
            for kind, ref, agrees, order, level in zip(*[part[c].tolist() for c in ("type", "ref", "agrees", "ord", "tier")], strict=True):
                seen = best.get((kind, ref))
                if seen is None or (order, not agrees) < (seen[1], not seen[0]):
                    best[kind, ref] = agrees, order, level
            for source, (agrees, order, level) in best.items():
                there = None if fresh else self.sources.getValue(source)
                if there is not None and (there[1], not there[0]) <= (order, not agrees):
                    continue
                if there is None:
                    n += 1
                else:
                    count(level, there[0], -1)
                count(level, agrees, 1)
                self.sources.updateValue(source, (agrees, order))
            fresh = False
        now = _verdict(**counts)
        changed = now != before
        self.summary.update((*counts.values(), n, change + changed, now))
        if changed:
            yield pd.DataFrame({"key": [key[0]], "flag": [key[1]], "confidence": [now], "n_sources": [n], "change": [change + 1]})

    def close(self) -> None:
        pass


def confidence_changes(evidence: DataFrame) -> DataFrame:
    """``key, flag, confidence``, the sources known by then, and the number of the change, of a stream of evidence.

    The session must have the settings ``PROVIDER``.
    """
    # Spark asks a worker beside the driver for the state's types; that one gets none of the session's files
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = evidence.select("key", "flag", "type", "ref", F.coalesce("agrees", F.lit(True)).alias("agrees"), F.coalesce("ord", F.lit(_LAST)).cast("long").alias("ord"), tier(F.col("type")).alias("tier"))
    rows = rows.mapInPandas(_least, _ROWS)
    return rows.groupBy("key", "flag").transformWithStateInPandas(statefulProcessor=FlagConfidence(), outputStructType=CHANGES, outputMode="Append", timeMode="None")


def _best(sources: DataFrame) -> DataFrame:
    return sources.groupBy(*_SOURCE).agg(F.min("best").alias("best"))


def _joined(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """By flag; null keys and flags are values."""
    b = b.withColumnsRenamed({c: f"__{c}" for c in _FLAG})
    return a.join(b, F.expr(" AND ".join(f"{c} <=> __{c}" for c in _FLAG)), how).drop(*[f"__{c}" for c in _FLAG])


class Increments:
    """Takes increments of evidence: the changes of confidence, as ``confidence_changes`` says them.

    Whatever an increment writes lies in a folder of its number, and is made from those of lower numbers only, so an
    increment that failed and is repeated replaces what it left.
    """

    schema = CHANGES

    def __init__(self, whole: int = WHOLE):
        self.whole = whole

    def __call__(self, spark: SparkSession, rows: DataFrame, number: int, target: str, kept: str) -> None:
        order = F.struct(F.coalesce("ord", F.lit(_LAST)).cast("long").alias("ord"), (~F.coalesce("agrees", F.lit(True))).alias("no"))
        mine = f"{kept}/increment={number}"
        _best(rows.select(*_SOURCE, order.alias("best"))).write.mode("overwrite").parquet(mine)
        new = self._read(spark, mine, _KEPT).drop("increment")
        named, sources = new.select(*_FLAG).distinct(), new
        if number:
            start = (number - 1) // self.whole * self.whole  # the last increment before this one that has all sources
            old = self._read(spark, kept, _KEPT).filter(F.col("increment").between(start, number - 1)).drop("increment")
            sources = _best(_joined(old, named, "left_semi").unionByName(new))
        level, agrees = tier(F.col("type")), ~F.col("best.no")
        some = lambda c: F.bool_or(c)
        yes, no, medium = some((level == "high") & agrees), some((level == "high") & ~agrees), some((level == "medium") & agrees)
        now = sources.groupBy(*_FLAG).agg(F.when(yes & ~no, "high").when((medium & ~no) | (yes & no), "medium").otherwise("low").alias("confidence"), F.count("*").alias("n_sources"))
        if number:
            said = self._read(spark, target, f"{CHANGES}, increment int").filter(F.col("increment") < number)
            said = said.groupBy(*_FLAG).agg(F.max_by("confidence", "change").alias("before"), F.max("change").alias("change"))
            now = _joined(now, said, "left").filter("before IS NULL OR confidence <> before").withColumn("change", F.coalesce("change", F.lit(0)) + 1)
        else:
            now = now.withColumn("change", F.lit(1).cast("long"))
        now.select("key", "flag", "confidence", "n_sources", "change").write.mode("overwrite").parquet(f"{target}/increment={number}")
        if number and number % self.whole == 0:
            # all sources up to here, those of this increment among them; written beside it first, as it is read for it
            every = written(_best(old.unionByName(new)), "sources")
            every.write.mode("overwrite").parquet(mine)
            released(every)

    @staticmethod
    def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(path)


def current(changes: DataFrame) -> DataFrame:
    """``key, flag, confidence`` after all changes so far."""
    return one_per_key(changes, ["key", "flag"], [F.col("change")], last=True).select("key", "flag", "confidence")
