"""Registered queries of look-ups, precedence and set operations, over the driver's tables with small literal ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.sheet import audit_verdict, changed_statements
from ..operators import evidence, lookups
from .common import Entry, sql_values, table, values

ROLES = [("c3", "CHEBI:1", "dye", "R:1", "is_fluorophore", True), ("c3", "CHEBI:1", "acid", None, "is_corrosive", None), ("c7", None, "salt", None, "is_hygroscopic", False), ("c7", None, "marker", "R:9", None, True), ("N/A", "CHEBI:0", "antibody", None, "is_protein", True)]


def customer_records(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.expr("CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('c', cast(c_nationkey AS STRING)) END").alias("cas"))


def role_lookup(spark) -> DataFrame:
    rows = values(spark, ROLES, "cas string, chebi_id string, term string, role_chebi string, flag string, agrees boolean")
    return rows.groupBy("cas", "chebi_id").agg(F.array_sort(F.collect_list(F.struct("term", "role_chebi", "flag", "agrees"))).alias("roles"))


def left_lookup_na_key(spark, sf_dir):
    return evidence.role_evidence(customer_records(spark, sf_dir), role_lookup(spark), "c_custkey").select("c_custkey", "flag", "ref", "agrees")


_CUSTOMER_CAS = "CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'c' || CAST(c_nationkey AS VARCHAR) END"
_NA = f"""WITH {sql_values(ROLES, 'r', 'cas, chebi_id, term, role_chebi, flag, agrees')}, c AS (SELECT c_custkey, coalesce(nullif({_CUSTOMER_CAS}, ''), 'N/A') AS cas FROM customer)
SELECT c_custkey, flag, coalesce(role_chebi, chebi_id || ':' || term, term) AS ref, coalesce(agrees, TRUE) AS agrees FROM c JOIN r USING (cas) WHERE flag IS NOT NULL"""

CACHE = [("sigma:11", "50-00-0", "sigma_sid"), ("sigma:12", None, "sigma_sid"), ("sigma:13", "64-17-5", "sigma_sid"), ("name:red bolt", "7732-18-5", "name_cid"), ("name:small ring", None, "name_miss"), ("name:hot gear", "67-56-1", "name_cid")]


def part_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("normalized_name"), F.expr("CASE p_size % 3 WHEN 0 THEN concat('Cat# ', cast(p_size AS STRING)) WHEN 1 THEN concat('#', cast(p_size AS STRING)) ELSE '' END").alias("identifier"))


def crosswalked(spark, sf_dir) -> DataFrame:
    return lookups.crosswalk(part_rows(spark, sf_dir), values(spark, CACHE, "key string, cas string, method string"))


def crosswalk_two_keys(spark, sf_dir):
    return crosswalked(spark, sf_dir).select("p_partkey", "cas", "cas_method")


def crosswalk_coverage(spark, sf_dir):
    return lookups.coverage(crosswalked(spark, sf_dir))


def crosswalk_uncached(spark, sf_dir):
    rows = part_rows(spark, sf_dir).withColumns({"k1": F.when(F.col("identifier") == "", "").otherwise(F.concat(F.lit("sigma:"), text.clean_catalog(F.col("identifier")))), "k2": F.concat(F.lit("name:"), F.col("normalized_name"))})
    return lookups.uncached(rows, values(spark, CACHE, "key string, cas string, method string"), "k1", "k2").select("p_partkey")


_CROSS = f"""WITH {sql_values(CACHE, 'k', 'key, cas, method')},
p AS (SELECT p_partkey, CASE WHEN p_size % 3 < 2 THEN 'sigma:' || CAST(p_size AS VARCHAR) END AS k1, 'name:' || p_name AS k2 FROM part),
x AS (SELECT p_partkey, CASE WHEN a.cas IS NOT NULL THEN a.cas ELSE b.cas END AS cas, CASE WHEN a.cas IS NOT NULL THEN a.method WHEN b.key IS NOT NULL THEN b.method ELSE 'not_queried' END AS cas_method, a.key AS ka, b.key AS kb FROM p LEFT JOIN k a ON k1 = a.key LEFT JOIN k b ON k2 = b.key)"""


def pending_anti(spark, sf_dir):
    return lookups.pending(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


def downloads_split(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels")
    todo, there = lookups.split_downloads(docs, labels.filter("quality = 0").select("doc_id"), labels.filter("toxic = 1").select("doc_id"), "doc_id")
    return todo.withColumn("state", F.lit("download")).unionByName(there.withColumn("state", F.lit("have_sheet")))


def orphans_union(spark, sf_dir):
    """Labels as the manifest (listed twice, once ineligible), documents as the files."""
    labels = table(spark, sf_dir, "labels")
    once = labels.select(F.col("doc_id").alias("pmcid"), (F.col("doc_id") * 2).alias("ord"), F.expr("CASE WHEN quality = 1 THEN 'True' ELSE 'no' END").alias("has_xml"), F.lit("yes").alias("fetch_ok"))
    again = once.filter("pmcid % 3 = 0").withColumns({"ord": F.col("ord") + 1, "has_xml": F.lit("1")})
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pmcid"))
    return lookups.with_orphans(once.unionByName(again), files).select("pmcid", "ord", "has_xml")


_ORPHANS = """WITH m AS (SELECT doc_id AS pmcid, doc_id * 2 AS ord, CASE WHEN quality = 1 THEN 'True' ELSE 'no' END AS has_xml FROM labels UNION ALL SELECT doc_id, doc_id * 2 + 1, '1' FROM labels WHERE doc_id % 3 = 0)
SELECT pmcid, min(ord) AS ord, arg_min(has_xml, ord) AS has_xml FROM m WHERE lower(has_xml) IN ('true', '1', 'yes') GROUP BY pmcid
UNION ALL SELECT DISTINCT doc_id, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR) FROM documents WHERE doc_id NOT IN (SELECT pmcid FROM m)"""

COUNTS = [("red bolt", 12), ("small-ring", 3), ("hot gear", 7), ("Brand 2", 99), ("brand 3", 41)]


def count_fallback(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.lower(F.replace("p_brand", F.lit("#"), F.lit(" "))).alias("other"))
    return lookups.count_with_fallback(rows, values(spark, COUNTS, "name string, n long"), "p_name", "other").select("p_partkey", "n")


def first_seen(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    return lookups.one_per_key(e, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id")


def canonical_per_cluster(spark, sf_dir):
    """Of a brand's part names, that which most lines order; the least name on ties."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    n = lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name"), "p_partkey").groupBy("p_brand", "p_name").agg(F.count("*").alias("n"))
    return lookups.one_per_key(n, ["p_brand"], [-F.col("n"), F.col("p_name")])


def limit_per_group(spark, sf_dir):
    return lookups.limited(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), [F.col("o_orderkey")], 2, ["o_custkey"])


def hits_total(spark, sf_dir):
    hits = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("journal"), F.lit(1).cast("long").alias("hits"))
    return lookups.hits_with_total(hits)


def either_key(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("a"), (F.col("s_suppkey") % 5).cast("string")).alias("k1"), F.concat(F.lit("b"), F.col("s_nationkey").cast("string")).alias("k2"))
    side = values(spark, [("a1", None), ("a3", "x"), ("b4", "y"), ("b7", "z")], "k string, v string")
    return lookups.by_either_key(rows, side, "k1", "k2", "k", "v").select("s_suppkey", "v")


def catalog_resolve(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("c"), (F.col("p_size") % 6).cast("string")).alias("cas"), F.col("p_name").alias("normalized_name"), F.concat(F.lit("#"), F.col("p_size").cast("string")).alias("identifier"), F.expr("CASE WHEN p_partkey % 3 = 0 THEN 'sigma_sid' ELSE 'name_cid' END").alias("cas_method"))
    cache, names = values(spark, [("c1", "K1"), ("c2", None)], "cas string, catalog string"), values(spark, [("red bolt", "N1"), ("hot gear", "N2")], "name string, catalog string")
    return lookups.resolve_catalog(rows, cache, names).select("p_partkey", "catalog", "catalog_from")


_CATALOG = """WITH c(cas, catalog) AS (VALUES ('c1', 'K1'), ('c2', NULL)), n(name, catalog) AS (VALUES ('red bolt', 'N1'), ('hot gear', 'N2')), p AS (SELECT p_partkey, 'c' || CAST(p_size % 6 AS VARCHAR) AS cas, p_name, p_size, p_partkey % 3 = 0 AS inline FROM part)
SELECT p_partkey, CASE WHEN c.cas IS NOT NULL THEN c.catalog WHEN inline THEN CAST(p_size AS VARCHAR) ELSE n.catalog END AS catalog, CASE WHEN c.cas IS NOT NULL THEN 'cached' WHEN inline THEN 'inline' WHEN n.name IS NOT NULL THEN 'by_name' ELSE 'none' END AS catalog_from
FROM p LEFT JOIN c USING (cas) LEFT JOIN n ON p_name = n.name"""


def registry_status(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    match = text.names_roughly_match(F.concat(F.col("c_mktsegment"), F.lit(" oxide")), F.expr("CASE c_custkey % 3 WHEN 0 THEN 'Automobile salt' WHEN 1 THEN 'oxi de' ELSE 'zinc-OXIDE' END"))
    return c.select("c_custkey", lookups.registry_status(F.expr("CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'x' END"), F.col("c_acctbal") > 0, F.col("c_custkey") % 5 != 0, match).alias("status"))


_STATUS = """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'no_cas' WHEN c_custkey % 5 = 0 THEN 'http_error' WHEN NOT c_acctbal > 0 THEN 'no_cid'
WHEN NOT (CASE c_custkey % 3 WHEN 0 THEN c_mktsegment = 'AUTOMOBILE' WHEN 1 THEN FALSE ELSE TRUE END) THEN 'name_mismatch' ELSE 'ok' END AS status FROM customer"""


def audit_agreement(spark, sf_dir):
    l = table(spark, sf_dir, "labels")  # noqa: E741
    return l.select("doc_id", audit_verdict(F.col("toxic") == 1, F.expr("CASE WHEN doc_id % 4 <> 0 THEN quality = 1 END")).alias("verdict"))


def change_detection(spark, sf_dir):
    before = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.expr("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END").alias("s"))
    after = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.expr("CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END").alias("s"))
    return evidence.changed(before, after, "o_orderkey", ["o_orderpriority", "s"])


def statement_difference(spark, sf_dir):
    """Event types of even and odd days, by user."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", (F.dayofyear("ts") % 2).alias("odd"))
    g = e.groupBy("user_id").agg(F.collect_set(F.when(F.col("odd") == 0, F.col("event_type"))).alias("old"), F.collect_set(F.when((F.col("odd") == 1) & (F.col("user_id") % 3 != 0), F.col("event_type"))).alias("new"))
    return g.select("user_id", *[F.array_join(F.array_sort(c), ",").alias(k) for k, c in changed_statements(F.col("old"), F.col("new")).items()])


_DIFF = """WITH e AS (SELECT DISTINCT user_id, event_type, dayofyear(ts) % 2 = 0 AS even FROM events), o AS (SELECT user_id, event_type FROM e WHERE even), n AS (SELECT user_id, event_type FROM e WHERE NOT even AND user_id % 3 <> 0),
a AS (SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS v FROM (SELECT * FROM n EXCEPT SELECT * FROM o) GROUP BY 1), r AS (SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS v FROM (SELECT * FROM o EXCEPT SELECT * FROM n) GROUP BY 1)
SELECT user_id, coalesce(a.v, '') AS added, coalesce(r.v, '') AS removed FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN a USING (user_id) LEFT JOIN r USING (user_id)"""

def existing_records(spark, sf_dir):
    """Sheets of all parts against records of all suppliers, under registry numbers, stems that look like them, and names."""
    sheets = table(spark, sf_dir, "part").select("p_partkey", F.expr("CASE p_partkey % 3 WHEN 0 THEN concat(p_size, '-1') WHEN 1 THEN '' END").alias("cas"), F.expr("CASE WHEN p_partkey % 2 = 0 THEN concat(p_size, '-1-2') ELSE concat('supplier-', p_size) END").alias("stem"))
    records = table(spark, sf_dir, "supplier").select(F.expr("CASE s_suppkey % 3 WHEN 0 THEN concat(s_suppkey, '-1') WHEN 1 THEN concat(s_suppkey, '-1-2') ELSE concat('supplier-', s_suppkey) END").alias("key"), F.col("s_name").alias("existing"))
    return lookups.with_existing(sheets, records).select("p_partkey", "cas", "existing")


_EXISTING = """WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size || '-1' END AS cas, CASE WHEN p_partkey % 2 = 0 THEN p_size || '-1-2' ELSE 'supplier-' || p_size END AS stem FROM part),
r AS (SELECT s_suppkey || CASE s_suppkey % 3 WHEN 0 THEN '-1' ELSE '-1-2' END AS k, s_name FROM supplier WHERE s_suppkey % 3 < 2 UNION ALL SELECT 'supplier-' || s_suppkey, s_name FROM supplier WHERE s_suppkey % 3 = 2)
SELECT p_partkey, coalesce(cas, CASE WHEN regexp_full_match(stem, '[0-9]+(-[0-9]+){1,2}') THEN stem END) AS cas, s_name AS existing FROM s LEFT JOIN r ON coalesce(cas, stem) = k"""


def cache_only(spark, sf_dir):
    """Customers as far as a cache of what their orders say knows them; a customer whose orders are all open is a remembered miss."""
    cache = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.max(F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority"))).alias("hit"))
    rows = lookups.cached_only(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name"), cache, "key")
    return rows.join(cache, "key", "left").select("key", "c_name", "hit")


def point_lookup(spark, sf_dir):
    """One supplier by its name."""
    return lookups.one_record(table(spark, sf_dir, "supplier"), "s_name", "Supplier#000000001").select("s_suppkey", "s_name", "s_nationkey")


ENTRIES: dict[str, Entry] = {
    "existing_records": (existing_records, _EXISTING),
    "cache_only": (cache_only, "SELECT c_custkey AS key, any_value(c_name) AS c_name, max(CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END) AS hit FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1"),
    "point_lookup": (point_lookup, "SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_name = 'Supplier#000000001'"),
    "left_lookup_na_key": (left_lookup_na_key, _NA),
    "crosswalk_two_keys": (crosswalk_two_keys, f"{_CROSS} SELECT p_partkey, cas, cas_method FROM x"),
    "crosswalk_coverage": (crosswalk_coverage, f"{_CROSS} SELECT count(*) AS total, count(cas) AS resolved, CAST(count_if(cas_method = 'not_queried') AS BIGINT) AS not_queried, CAST(count_if(cas IS NULL AND cas_method <> 'not_queried') AS BIGINT) AS still_null FROM x"),
    "crosswalk_uncached": (crosswalk_uncached, f"{_CROSS} SELECT p_partkey FROM x WHERE ka IS NULL AND kb IS NULL"),
    "pending_anti": (pending_anti, "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
    "downloads_split": (downloads_split, "SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'have_sheet' ELSE 'download' END AS state FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)"),
    "orphans_union": (orphans_union, _ORPHANS),
    "count_fallback": (count_fallback, f"WITH {sql_values(COUNTS, 'c', 'name, n')} SELECT p_partkey, CAST(coalesce(a.n, b.n, 0) AS BIGINT) AS n FROM part LEFT JOIN c a ON p_name = a.name LEFT JOIN c b ON lower(replace(p_brand, '#', ' ')) = b.name"),
    "first_seen": (first_seen, "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1"),
    "canonical_per_cluster": (canonical_per_cluster, "SELECT p_brand, p_name, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_name) = 1"),
    "limit_per_group": (limit_per_group, "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 2"),
    "hits_total": (hits_total, "SELECT c_mktsegment AS journal, count(*) AS hits FROM customer GROUP BY 1 UNION ALL SELECT 'TOTAL', count(*) FROM customer"),
    "either_key": (either_key, "WITH k(k, v) AS (VALUES ('a1', NULL), ('a3', 'x'), ('b4', 'y'), ('b7', 'z')) SELECT s_suppkey, CASE WHEN a.k IS NOT NULL THEN a.v ELSE b.v END AS v FROM supplier LEFT JOIN k a ON 'a' || CAST(s_suppkey % 5 AS VARCHAR) = a.k LEFT JOIN k b ON 'b' || CAST(s_nationkey AS VARCHAR) = b.k"),
    "catalog_resolve": (catalog_resolve, _CATALOG),
    "registry_status": (registry_status, _STATUS),
    "audit_agreement": (audit_agreement, "WITH l AS (SELECT doc_id, toxic = 1 AS hit, CASE WHEN doc_id % 4 <> 0 THEN quality = 1 END AS stored FROM labels) SELECT doc_id, CASE WHEN (hit AND coalesce(stored, FALSE)) OR (NOT hit AND coalesce(NOT stored, FALSE)) THEN 'agree' ELSE 'DISAGREE' END AS verdict FROM l"),
    "change_detection": (change_detection, "SELECT o_orderkey FROM orders WHERE (CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END) IS DISTINCT FROM (CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END)"),
    "statement_difference": (statement_difference, _DIFF),
}
