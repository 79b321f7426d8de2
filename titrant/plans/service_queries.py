"""Registered queries of service answers, over parts and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import services
from .common import Entry, table


def substance_lookup(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    known = p.select(F.concat((F.col("p_partkey") % 50).cast("string"), F.expr("CASE p_partkey % 3 WHEN 0 THEN '_SIGMA' WHEN 1 THEN '_SIAL' ELSE '' END")).alias("registry_id"), F.col("p_partkey").alias("cid"), (F.col("p_size") % 2).alias("compound_type"))
    return services.substance_of(p.select("p_partkey", F.concat(F.lit("Cat# "), F.col("p_size").cast("string")).alias("identifier")), known).select("p_partkey", "cid")


_SUBSTANCE = """WITH k AS (SELECT CAST(p_partkey % 50 AS VARCHAR) AS n, p_partkey % 3 AS o, p_partkey AS cid FROM part WHERE p_size % 2 = 1), b AS (SELECT n, arg_min(cid, o * 1000000000 + cid) AS cid FROM k GROUP BY n)
SELECT p_partkey, cid FROM part LEFT JOIN b ON CAST(p_size AS VARCHAR) = n"""


def first_cas(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cid"), F.col("l_linenumber").alias("ord"), F.expr("CASE WHEN l_partkey % 4 = 0 THEN concat(' ', cast(l_partkey AS STRING), '-', lpad(cast(l_suppkey % 100 AS STRING), 2, '0'), '-1') ELSE 'name' END").alias("synonym"))
    return services.first_cas(s)


def vendor_catalog(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cid"), F.col("l_linenumber").alias("ord"), F.concat(F.lit("Sigma "), "l_returnflag").alias("source"), F.concat(F.lit("S"), F.col("l_partkey").cast("string"), F.expr("CASE WHEN l_suppkey % 2 = 0 THEN '_SIAL' ELSE '' END")).alias("registry_id"))
    return services.vendor_catalog(s, ("sigma r", "aldrich"), 5)


def first_reviewed(spark, sf_dir):
    h = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), (F.col("l_linenumber") % 2).alias("query_ord"), F.col("l_linenumber").alias("hit_ord"), (F.col("l_linestatus") == "O").alias("reviewed"), F.col("l_partkey").cast("string").alias("accession"))
    return services.first_reviewed(h)


def hit_tally(spark, sf_dir):
    return services.tally(table(spark, sf_dir, "part").select(F.col("p_type").alias("flag"), F.col("p_name").alias("hit")))


ENTRIES: dict[str, Entry] = {
    "substance_lookup": (substance_lookup, _SUBSTANCE),
    "first_cas": (first_cas, "SELECT l_orderkey AS cid, CAST(l_partkey AS VARCHAR) || '-' || lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0') || '-1' AS cas FROM lineitem WHERE l_partkey % 4 = 0 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, cas) = 1"),
    "vendor_catalog": (vendor_catalog, "SELECT l_orderkey AS cid, 'S' || CAST(l_partkey AS VARCHAR) AS catalog FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber < 5 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, 'S' || CAST(l_partkey AS VARCHAR) || CASE WHEN l_suppkey % 2 = 0 THEN '_SIAL' ELSE '' END) = 1"),
    "first_reviewed": (first_reviewed, "SELECT l_orderkey AS key, CAST(l_partkey AS VARCHAR) AS accession FROM lineitem WHERE l_linestatus = 'O' QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber % 2, l_linenumber, accession) = 1"),
    "hit_tally": (hit_tally, "WITH d AS (SELECT p_type, p_name, count(*) AS n, row_number() OVER (PARTITION BY p_type ORDER BY p_name) AS r FROM part GROUP BY 1, 2) SELECT p_type AS flag, CAST(sum(n) AS BIGINT) AS n, max(CASE WHEN r = 1 THEN p_name END) AS first, max(CASE WHEN r = 2 THEN p_name END) AS second FROM d GROUP BY 1"),
}
