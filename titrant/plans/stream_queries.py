"""Registered queries of incremental work: evidence fused as it arrives, and keys seen for the first time."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources.folders import shared
from ..streaming import fusion, incremental
from .common import Entry, table


def shipped_evidence(spark, sf_dir: str):
    """Every line of an order as evidence on its part, from a group of suppliers: what kind of evidence is the line number's matter."""
    kind = "CASE l_linenumber WHEN 1 THEN 'sds_phrase' WHEN 2 THEN 'chebi' WHEN 3 THEN 'manufacturer_protocol' WHEN 4 THEN 'tacit_knowledge' WHEN 5 THEN 'rule_derived' ELSE 'hearsay' END"
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        F.col("l_partkey").cast("string").alias("key"), F.concat(F.lit("flag "), F.col("l_suppkey") % 3).alias("flag"), F.expr(kind).alias("type"), F.concat(F.lit("group "), F.col("l_suppkey") % 4).alias("ref"),
        F.expr("CASE WHEN l_returnflag = 'R' THEN false WHEN l_linestatus = 'O' THEN true END").alias("agrees"), (F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber")).alias("ord"), (F.col("l_orderkey") % 3).alias("part"),
    )


def evidence_incremental(spark, sf_dir):
    """Evidence in two increments, the second of which has rows that come before ones of the first; then a run without anything new."""
    folder = f"{shared(spark)}/evidence-{uuid.uuid4().hex}"
    rows = shipped_evidence(spark, sf_dir)
    changes = None
    for part in ("part <> 1", "part = 1", None):
        if part is not None:
            rows.filter(part).drop("part").write.mode("append").parquet(f"{folder}/in")
        changes = incremental.ingest(spark, f"{folder}/in", rows.drop("part").schema, f"{folder}/out", f"{folder}/state", fusion.Increments())
    return fusion.current(changes)


_FUSED = """WITH e AS (SELECT CAST(l_partkey AS VARCHAR) AS key, 'flag ' || (l_suppkey % 3) AS flag, least(l_linenumber, 6) AS type, l_suppkey % 4 AS ref, l_returnflag <> 'R' AS agrees, l_orderkey * 8 + l_linenumber AS ord FROM lineitem),
f AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY key, flag, type, ref ORDER BY ord, agrees DESC) = 1),
c AS (SELECT key, flag, bool_or(type <= 2 AND agrees) AS hy, bool_or(type <= 2 AND NOT agrees) AS hn, bool_or(type = 3 AND agrees) AS my FROM f GROUP BY 1, 2)
SELECT key, flag, CASE WHEN hy AND NOT hn THEN 'high' WHEN (my AND NOT hn) OR (hy AND hn) THEN 'medium' ELSE 'low' END AS confidence FROM c"""


def events_first_keys(spark, sf_dir):
    """Users and what they did at least once, of a stream that remembers keys behind its watermark; a second run adds nothing."""
    folder = f"{shared(spark)}/first-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    for _ in range(2):
        seen = incremental.ingest(spark, f"{sf_dir}/events.parquet*", schema, f"{folder}/out", f"{folder}/state", lambda df: incremental.first_seen(df.select("user_id", "event_type", "ts"), ["user_id", "event_type"], late="3650 days").select("user_id", "event_type"))
    return seen


ENTRIES: dict[str, Entry] = {
    "evidence_incremental": (evidence_incremental, _FUSED),
    "events_first_keys": (events_first_keys, "SELECT DISTINCT user_id, event_type FROM events"),
}
