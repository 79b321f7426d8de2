"""Registered queries of the rules engine and of evidence fusion, over ``part``, ``supplier`` and ``events``.

Records are parts. Their properties are made from part columns by expressions that both engines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evidence, rule_index, rules
from ..schemas import FLAGS
from .common import Entry, quoted, spread, sql_values, table
from .ingest import standard_rules, standard_summaries

NUMBERS = {"glycerol_pct": "p_size * 1.5", "vapor_pressure_kPa_20C": "(p_partkey % 13) * 0.75", "freeze_point_C": "(p_partkey % 29) - 5.0"}
TEXTS = {"physical_state": "CASE p_partkey % 5 WHEN 0 THEN 'liquid' WHEN 1 THEN 'solution' WHEN 2 THEN 'powder' WHEN 3 THEN 'solid' END", "viscosity_class": "CASE p_size % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'moderate' WHEN 2 THEN 'high' END"}


def flag_sql(i: int) -> str:
    """The i-th flag of a part: null for some, true for some."""
    return f"CASE WHEN (p_partkey + {i}) % 7 = 0 THEN NULL ELSE (p_partkey * {i + 3} + p_size) % {5 + i % 3} = 0 END"


def confidence_sql(i: int) -> str:
    return f"CASE (p_partkey + {i}) % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' END"


def property_sql(name: str) -> str:
    return NUMBERS.get(name) or TEXTS.get(name) or flag_sql(FLAGS.index(name))


def _confidence_of(name: str) -> str:
    return "CAST(NULL AS STRING)" if name in NUMBERS or name in TEXTS else confidence_sql(FLAGS.index(name))


def applied(spark, sf_dir) -> DataFrame:
    parts = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), "p_partkey")
    return rule_index.apply_indexed(parts, standard_rules(), lambda p: F.expr(property_sql(p)), lambda p: F.expr(_confidence_of(p)))


_SQL_OPS = {"gt": ">", "gte": ">=", "lt": "<", "lte": "<=", "eq": "=", "ne": "<>"}


def _condition_sql(name: str, wanted: object) -> str:
    tests = wanted if isinstance(wanted, dict) else {"eq": wanted}
    return " AND ".join(f"coalesce(({property_sql(name)}) {_SQL_OPS[op]} {quoted(v)}, FALSE)" for op, v in tests.items())


def _rank_sql(name: str) -> str:
    return f"CASE coalesce({_confidence_of(name).replace('STRING', 'VARCHAR')}, 'high') WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END"


def fired_sql() -> str:
    """``fired``: p_partkey, ord, id, confidence, field_consensus; ``write``: ord, path, value."""
    arms = []
    for i, r in enumerate(standard_rules()):
        conf = f"CASE least({', '.join(_rank_sql(p) for p in r.when)}) WHEN 2 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END"
        arms.append(f"SELECT p_partkey, {i} AS ord, '{r.id}' AS id, {conf} AS confidence, {str(r.field_consensus).upper()} AS field_consensus FROM part WHERE {' AND '.join(_condition_sql(p, w) for p, w in r.when.items())}")
    writes = [(i, k, rules.literal(v)) for i, r in enumerate(standard_rules()) for k, v in r.then.items()]
    return "WITH fired AS (" + " UNION ALL ".join(arms) + "), " + sql_values(writes, "write", "ord, path, value")


def rules_fired_long(spark, sf_dir):
    return rules.fired_long(applied(spark, sf_dir), "p_partkey").select("p_partkey", "ord", "id", "confidence", "field_consensus")


def rules_profile_merge(spark, sf_dir):
    return applied(spark, sf_dir).select("p_partkey", F.explode("profile").alias("path", "value"))


def rules_conflicts(spark, sf_dir):
    return rules.conflicts(applied(spark, sf_dir), standard_rules(), "p_partkey").select("p_partkey", "path", "n_values", F.array_join("values", "|").alias("all_values"), F.array_join("rules", "|").alias("by_rules"))


def rules_histogram(spark, sf_dir):
    return rules.histogram(applied(spark, sf_dir))


def rules_frequency(spark, sf_dir):
    return rules.frequency(applied(spark, sf_dir))


def rule_confidence(spark, sf_dir):
    return rules.fired_long(applied(spark, sf_dir)).groupBy("id", "confidence").agg(F.count("*").alias("n"))


def rules_min_report(spark, sf_dir):
    return rules.with_least_rules(applied(spark, sf_dir), 8).select("p_partkey", F.size("rules_fired").alias("n_rules"))


#: So many rules the query of the index has.
MANY = 5000
_MANY_VALUES = {"size": "p_size", "brand": "p_brand", "type": "p_type", "price": "p_retailprice", "flag": flag_sql(0)}
_MANY_CONFIDENCE = {"size": confidence_sql(1), "brand": confidence_sql(2)}


def many_rules(n: int = MANY) -> list[rules.Rule]:
    """Rules by formula: a window of sizes, and most of them a brand; some a type that isn't, a least price, a flag."""
    out = []
    for k in range(n):
        when: dict = {"size": {"gte": k % 48, "lt": k % 48 + 2 + k % 3}}
        if k % 8:
            when["brand"] = f"Brand#{k % 25 + 1}"
        if k % 3 == 0:
            when["type"] = {"ne": ("ECONOMY", "LARGE", "MEDIUM")[k % 9 // 3]}
        if k % 5 == 0:
            when["price"] = {"gt": 900.0 + k % 90}
        if k % 7 == 0:
            when["flag"] = k % 2 == 0
        out.append(rules.Rule(f"r{k}", when, {f"g{k % 9}.p{k % 13}": k % 5}))
    return out


def rules_by_the_thousand(spark, sf_dir):
    a = rule_index.apply_indexed(spread(table(spark, sf_dir, "part"), "p_partkey"), many_rules(), lambda p: F.expr(_MANY_VALUES[p]), lambda p: F.expr(_MANY_CONFIDENCE.get(p, "CAST(NULL AS STRING)")))
    many = lambda c: F.size(F.filter("rules_fired", lambda r: r["confidence"] == c)).cast("long")
    paths = F.array_sort(F.transform(F.map_entries("profile"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return a.select(
        "p_partkey", F.size("rules_fired").cast("long").alias("n_rules"), F.aggregate("rules_fired", F.lit(0).cast("long"), lambda s, r: s + r["ord"]).alias("ord_sum"), many("low").alias("n_low"), many("medium").alias("n_medium"),
        F.get("rules_fired", F.lit(0))["id"].alias("first_id"), F.array_join(paths, "|").alias("profile"),
    )


_MANY_SQL = f"""WITH r AS (SELECT k FROM range({MANY}) t(k)),
f AS (SELECT p_partkey, k, least(CASE coalesce({confidence_sql(1)}, 'high') WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END, CASE WHEN k % 8 = 0 THEN 2 ELSE CASE coalesce({confidence_sql(2)}, 'high') WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END END) AS c
      FROM part JOIN r ON p_size >= k % 48 AND p_size < k % 48 + 2 + k % 3 AND (k % 8 = 0 OR p_brand = 'Brand#' || CAST(k % 25 + 1 AS VARCHAR))
      WHERE (k % 3 <> 0 OR p_type <> CASE k % 9 WHEN 0 THEN 'ECONOMY' WHEN 3 THEN 'LARGE' ELSE 'MEDIUM' END) AND (k % 5 <> 0 OR p_retailprice > 900.0 + k % 90) AND (k % 7 <> 0 OR coalesce(({flag_sql(0)}) = (k % 2 = 0), FALSE))),
w AS (SELECT p_partkey, 'g' || CAST(k % 9 AS VARCHAR) || '.p' || CAST(k % 13 AS VARCHAR) || '=' || CAST(arg_max(k % 5, k) AS VARCHAR) AS path FROM f GROUP BY p_partkey, k % 9, k % 13),
n AS (SELECT p_partkey, count(*) AS n, sum(k) AS s, count_if(c = 0) AS low, count_if(c = 1) AS medium, 'r' || CAST(min(k) AS VARCHAR) AS first_id FROM f GROUP BY 1),
j AS (SELECT p_partkey, string_agg(path, '|' ORDER BY path) AS profile FROM w GROUP BY 1)
SELECT p_partkey, coalesce(n, 0) AS n_rules, CAST(coalesce(s, 0) AS BIGINT) AS ord_sum, CAST(coalesce(low, 0) AS BIGINT) AS n_low, CAST(coalesce(medium, 0) AS BIGINT) AS n_medium, first_id, coalesce(profile, '') AS profile
FROM part LEFT JOIN n USING (p_partkey) LEFT JOIN j USING (p_partkey)"""


def manifest_index(spark, sf_dir):
    a = applied(spark, sf_dir).withColumn("key", F.col("p_partkey").cast("string"))
    pictures = F.array_compact(F.array(*[F.when(F.expr(f"(p_partkey + {i}) % {i + 3} = 0"), F.lit(p)) for i, p in enumerate(("exclamation_mark", "compressed_gas", "flame", "corrosion", "health_hazard"))]))
    records = a.select("key", F.col("p_name").alias("name"), F.lit(None).cast("string").alias("cas"), F.expr("CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN p_type END").alias("category"), F.struct(pictures.alias("pictograms"), F.expr("CASE WHEN p_size > 25 THEN 'Danger' END").alias("signal_word")).alias("ghs"))
    # a record whose number ends in 7 has no profile
    return rules.manifest(records, a.filter("p_partkey % 10 <> 7").select("key", "rules_fired"), standard_summaries())


def _manifest_sql() -> str:
    order = list(standard_summaries())
    facts = sql_values([(i, k, v) for i, (k, v) in enumerate(standard_summaries().items())], "fact", "o, id, sentence")
    pictures = [("exclamation_mark", 0), ("compressed_gas", 1), ("flame", 2), ("corrosion", 3), ("health_hazard", 4)]
    listed = " UNION ALL ".join(f"SELECT p_partkey, '{p}' AS pic, {i} AS o FROM part WHERE (p_partkey + {i}) % {i + 3} = 0" for p, i in pictures)
    severity = sql_values([(i, p) for i, p in enumerate(rules.SEVERITY)], "severity", "s, pic")
    assert len(order) == len(standard_rules())
    return f"""{fired_sql()}, {facts}, {severity}, pics AS ({listed}),
f AS (SELECT * FROM fired WHERE p_partkey % 10 <> 7),
n AS (SELECT p_partkey, count(*) AS n FROM f GROUP BY 1),
best AS (SELECT p_partkey, arg_min(sentence, o) AS sentence FROM f JOIN fact USING (id) GROUP BY 1),
top AS (SELECT p_partkey, arg_min(pics.pic, CASE WHEN s IS NULL THEN 100 + pics.o ELSE s END) AS pic FROM pics LEFT JOIN severity USING (pic) GROUP BY 1)
SELECT p_name AS name, CAST(NULL AS VARCHAR) AS cas, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN p_type END AS category, top.pic AS top_pictogram, CASE WHEN p_size > 25 THEN 'Danger' END AS signal_word,
       coalesce(best.sentence, 'No special handling required') AS summary_fact, CAST(coalesce(n.n, 0) AS INTEGER) AS rules_fired_count, CAST(p_partkey AS VARCHAR) || '.json' AS file
FROM part LEFT JOIN n USING (p_partkey) LEFT JOIN best USING (p_partkey) LEFT JOIN top USING (p_partkey)"""


# Evidence: an event is a source; its type and value say of what kind it is and whether it agrees.
KIND = "CASE event_type WHEN 'signup' THEN 'ghs_hcode' WHEN 'purchase' THEN 'manufacturer_protocol' WHEN 'error' THEN 'tacit_knowledge' WHEN 'click' THEN 'rule_derived' ELSE 'hearsay' END"
AGREES = "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value > 6 END"
DAY = "CAST(CAST(ts AS DATE) AS STRING)"
_TIERS = "CASE type WHEN 'ghs_hcode' THEN 'high' WHEN 'manufacturer_protocol' THEN 'medium' WHEN 'rule_derived' THEN 'inherit' ELSE 'low' END"
_SOURCES = f"s AS (SELECT user_id, {DAY} AS day, event_id, {KIND} AS type, {AGREES} AS agrees, value FROM events)"
_A1 = "CASE WHEN hy AND NOT hn THEN 'high' WHEN (my AND NOT hn) OR (hy AND hn) THEN 'medium' ELSE 'low' END"
_SUMS = f"coalesce(bool_or({_TIERS} = 'high' AND coalesce(agrees, TRUE)), FALSE) AS hy, coalesce(bool_or({_TIERS} = 'high' AND NOT coalesce(agrees, TRUE)), FALSE) AS hn, coalesce(bool_or({_TIERS} = 'medium' AND coalesce(agrees, TRUE)), FALSE) AS my"


def sources(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("user_id", F.expr(DAY).alias("day"), "event_id", F.expr(KIND).alias("type"), F.expr(AGREES).alias("agrees"), "value", "event_type", "ts")


def evidence_confidence(spark, sf_dir):
    return evidence.confidence_long(sources(spark, sf_dir), "user_id", "day")


def evidence_inherit(spark, sf_dir):
    s = sources(spark, sf_dir)
    source = F.struct("event_id", "type", F.when(F.col("type") == "rule_derived", F.lit("rule_derived:parent→child")).otherwise(F.col("type")).alias("ref"), "agrees")
    g = s.groupBy("user_id", "day").agg(F.transform(F.array_sort(F.collect_list(source)), lambda x: F.struct(x["type"].alias("type"), x["ref"].alias("ref"), x["agrees"].alias("agrees"))).alias("sources"))
    parent = F.struct(F.lit(True).alias("value"), F.expr("CASE user_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' END").alias("confidence"), F.col("sources"))
    return g.select("user_id", "day", evidence.inherited_confidence(F.col("sources"), F.create_map(F.lit("parent"), parent)).alias("confidence"))


def evidence_union_first_writer(spark, sf_dir):
    rows = sources(spark, sf_dir).select("user_id", F.col("event_type").alias("flag"), "type", F.concat(F.lit("ref"), (F.floor("value") % 5).cast("string")).alias("ref"), "agrees", "ts", "event_id")
    return evidence.union_long(rows, ("user_id", "flag"), ("ts", "event_id")).select("user_id", "flag", "type", "ref", "agrees", "event_id")


def evidence_set_value(spark, sf_dir):
    g = sources(spark, sf_dir).groupBy("user_id").agg(F.bool_or(F.coalesce("agrees", F.lit(True)) & (F.col("value") > 60)).alias("new"))
    stored = F.expr("CASE user_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END")
    return g.select("user_id", evidence.settled_value(stored, F.col("new")).alias("value"))


CATEGORY = "CASE s_suppkey % 7 WHEN 0 THEN 'fluorophore' WHEN 1 THEN 'reducing_agent' WHEN 2 THEN 'fixative' WHEN 3 THEN 'detergent' WHEN 4 THEN 'enzyme_glycerol' ELSE 'buffer' END"
STORED = "CASE s_suppkey % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END"


def supplier_records(spark, sf_dir) -> DataFrame:
    source = F.array(F.struct(F.expr("CASE WHEN s_suppkey % 2 = 0 THEN 'chebi' ELSE 'manufacturer_protocol' END").alias("type"), F.lit("r").alias("ref"), F.expr("s_acctbal > 0").alias("agrees")))
    flags = F.map_from_entries(F.array(*[F.struct(F.lit(f).alias("key"), F.struct(F.expr(f"CASE WHEN s_nationkey % {i + 2} = 0 THEN TRUE END").alias("value"), F.expr(STORED).alias("confidence"), source.alias("sources")).alias("value")) for i, (_, f) in enumerate(evidence.INVARIANTS)]))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.expr("CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE s_name END").alias("name"), F.expr("CASE WHEN s_suppkey % 9 = 0 THEN '1.0' ELSE '2.0' END").alias("schema_version"), F.expr("CASE WHEN s_suppkey % 13 = 0 THEN 'gas' ELSE 'liquid' END").alias("physical_state"),
        F.expr(CATEGORY).alias("category"), flags.alias("flags"),
    )


_TRUE = "CASE WHEN s_suppkey % 2 = 0 THEN CASE WHEN s_acctbal > 0 THEN 'high' ELSE 'low' END ELSE CASE WHEN s_acctbal > 0 THEN 'medium' ELSE 'low' END END"
_WARN = " UNION ALL ".join(
    [f"SELECT s_suppkey, 'CONF {f}: stored=' || {STORED} || ' computed=' || {_TRUE} AS warning FROM supplier WHERE s_suppkey % 9 <> 0 AND {STORED} <> {_TRUE}" for _, f in evidence.INVARIANTS]
    + [f"SELECT s_suppkey, 'INVAR category={c} implies {f}' AS warning FROM supplier WHERE s_suppkey % 9 <> 0 AND {CATEGORY} = '{c}' AND s_nationkey % {i + 2} <> 0" for i, (c, f) in enumerate(evidence.INVARIANTS)]
)
_STATUS = f"""WITH w AS ({_WARN}), n AS (SELECT s_suppkey, count(*) AS n FROM w GROUP BY 1)
, st AS (SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 OR s_suppkey % 9 = 0 OR s_suppkey % 13 = 0 THEN 'failed' WHEN n > 0 THEN 'warned' ELSE 'passed' END AS status FROM supplier LEFT JOIN n USING (s_suppkey))"""


def validate_status(spark, sf_dir):
    return evidence.validate(supplier_records(spark, sf_dir)).select("s_suppkey", "status")


def validate_warnings(spark, sf_dir):
    return evidence.validate(supplier_records(spark, sf_dir)).select("s_suppkey", F.explode("warnings").alias("warning"))


def validate_counts(spark, sf_dir):
    return evidence.validation_counts(evidence.validate(supplier_records(spark, sf_dir)))


def evidence_enrich(spark, sf_dir):
    """Supplier records with events as evidence (a user is a supplier), fused in one join; records of the first version (every ninth) are passed over."""
    new = sources(spark, sf_dir).select(F.col("user_id").alias("s_suppkey"), F.lit("is_protein").alias("flag"), "type", F.concat(F.lit("e"), (F.floor("value") % 3).cast("string")).alias("ref"), "agrees", F.col("event_id").alias("ord"))
    out = evidence.enrich(supplier_records(spark, sf_dir), new, "s_suppkey")
    f = F.col("flags")["is_protein"]
    return out.select("s_suppkey", f["value"].alias("value"), f["confidence"].alias("confidence"), F.size(f["sources"]).alias("n_sources"))


_ENRICH = f"""WITH {_SOURCES}, r AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'chebi' ELSE 'manufacturer_protocol' END AS type, 'r' AS ref, s_acctbal > 0 AS agrees, -1 AS ord FROM supplier),
x AS (SELECT user_id AS s_suppkey, type, 'e' || CAST(CAST(floor(value) AS BIGINT) % 3 AS VARCHAR) AS ref, agrees, event_id AS ord FROM s WHERE user_id IN (SELECT s_suppkey FROM supplier) AND user_id % 9 <> 0),
every AS (SELECT * FROM r UNION ALL SELECT * FROM x),
one AS (SELECT *, {_TIERS.replace("WHEN 'ghs_hcode' THEN 'high'", "WHEN 'ghs_hcode' THEN 'high' WHEN 'chebi' THEN 'high'")} AS tier FROM every QUALIFY row_number() OVER (PARTITION BY s_suppkey, type, ref ORDER BY ord) = 1),
g AS (SELECT s_suppkey, count(*) AS n, bool_or(tier = 'high' AND coalesce(agrees, TRUE)) AS hy, bool_or(tier = 'high' AND NOT coalesce(agrees, TRUE)) AS hn, bool_or(tier = 'medium' AND coalesce(agrees, TRUE)) AS my FROM one GROUP BY 1),
a AS (SELECT s_suppkey, bool_or(coalesce(agrees, TRUE)) AS any_new FROM x GROUP BY 1)
SELECT s_suppkey, CASE WHEN s_nationkey % 6 = 0 THEN TRUE WHEN any_new THEN TRUE END AS value, CASE WHEN any_new IS NULL THEN {STORED} ELSE {_A1} END AS confidence, CAST(n AS INTEGER) AS n_sources
FROM supplier JOIN g USING (s_suppkey) LEFT JOIN a USING (s_suppkey)"""

OVERRIDES = [("ECONOMY", "budget", 42.0, True, None), ("PROMO", "offer", None, False, True), ("N/A", "unknown", 1.0, True, False)]


def override_apply(spark, sf_dir):
    """Parts by type, with types that end in D unknown; the table can change known values."""
    side = spark.createDataFrame([(c, k, {"glycerol_pct": str(g)} if g is not None else {}, {n: v for n, v in (("is_protein", p), ("is_serum", s)) if v is not None}) for c, k, g, p, s in OVERRIDES], "cas string, category string, numerics map<string,string>, flags map<string,boolean>")
    flag = lambda i: F.struct(F.expr(flag_sql(i)).alias("value"), F.lit("low").alias("confidence"), F.array().cast(evidence.SOURCES_TYPE).alias("sources"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr("CASE WHEN p_type LIKE '%D' THEN NULL ELSE p_type END").alias("cas"), F.col("p_brand").alias("category"), F.struct((F.col("p_size") * 1.5).alias("glycerol_pct")).alias("numerics"), F.create_map(F.lit("is_protein"), flag(0)).alias("flags"))
    out = evidence.apply_overrides(rows, side, "curated")
    return out.select("p_partkey", "category", F.col("numerics.glycerol_pct").alias("glycerol_pct"), F.col("flags")["is_protein"]["value"].alias("is_protein"), F.try_element_at("flags", F.lit("is_serum"))["value"].alias("is_serum"), F.size("flags").alias("n_flags"))


_OVERRIDE = f"""WITH {sql_values(OVERRIDES, 'o', 'k, cat, g, p, s')}
SELECT p_partkey, coalesce(cat, p_brand) AS category, CAST(coalesce(g, p_size * 1.5) AS DOUBLE) AS glycerol_pct, CASE WHEN k IS NULL THEN {flag_sql(0)} ELSE p END AS is_protein, s AS is_serum, CASE WHEN s IS NULL THEN 1 ELSE 2 END AS n_flags
FROM part LEFT JOIN o ON CASE WHEN p_type LIKE '%D' THEN 'N/A' ELSE p_type END = k"""

ENTRIES: dict[str, Entry] = {
    "rules_fired_long": (rules_fired_long, f"{fired_sql()} SELECT p_partkey, ord, id, confidence, field_consensus FROM fired"),
    "rules_profile_merge": (rules_profile_merge, f"{fired_sql()} SELECT p_partkey, path, arg_max(value, ord) AS value FROM fired JOIN write USING (ord) GROUP BY 1, 2"),
    "rules_conflicts": (rules_conflicts, f"{fired_sql()} SELECT p_partkey, path, CAST(count(DISTINCT value) AS INTEGER) AS n_values, string_agg(DISTINCT value, '|' ORDER BY value) AS all_values, string_agg(id, '|' ORDER BY ord) AS by_rules FROM fired JOIN write USING (ord) GROUP BY 1, 2 HAVING count(DISTINCT value) > 1"),
    "rules_histogram": (rules_histogram, f"{fired_sql()} SELECT CAST(coalesce(n, 0) AS INTEGER) AS n_rules, count(*) AS n_records FROM part LEFT JOIN (SELECT p_partkey, count(*) AS n FROM fired GROUP BY 1) USING (p_partkey) GROUP BY 1"),
    "rules_frequency": (rules_frequency, f"{fired_sql()} SELECT id, count(*) AS n FROM fired GROUP BY 1"),
    "rule_confidence": (rule_confidence, f"{fired_sql()} SELECT id, confidence, count(*) AS n FROM fired GROUP BY 1, 2"),
    "rules_min_report": (rules_min_report, f"{fired_sql()} SELECT p_partkey, CAST(count(*) AS INTEGER) AS n_rules FROM fired GROUP BY 1 HAVING count(*) >= 8"),
    "rules_by_the_thousand": (rules_by_the_thousand, _MANY_SQL),
    "manifest_index": (manifest_index, _manifest_sql()),
    "evidence_confidence": (evidence_confidence, f"WITH {_SOURCES}, g AS (SELECT user_id, day, {_SUMS} FROM s GROUP BY 1, 2) SELECT user_id, day, {_A1} AS confidence FROM g"),
    "evidence_inherit": (evidence_inherit, f"WITH {_SOURCES}, g AS (SELECT user_id, day, {_SUMS}, bool_or(type = 'rule_derived') AS d, bool_or({_TIERS} IN ('high', 'medium')) AS sub FROM s GROUP BY 1, 2) SELECT user_id, day, CASE WHEN d AND NOT sub THEN coalesce(CASE user_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' END, {_A1}) ELSE {_A1} END AS confidence FROM g"),
    "evidence_union_first_writer": (evidence_union_first_writer, f"SELECT user_id, event_type AS flag, {KIND} AS type, 'ref' || CAST(CAST(floor(value) AS BIGINT) % 5 AS VARCHAR) AS ref, {AGREES} AS agrees, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, {KIND}, CAST(floor(value) AS BIGINT) % 5 ORDER BY ts, event_id) = 1"),
    "evidence_set_value": (evidence_set_value, f"WITH {_SOURCES}, g AS (SELECT user_id, bool_or(coalesce(agrees, TRUE) AND value > 60) AS new FROM s GROUP BY 1) SELECT user_id, CASE user_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE CASE WHEN new THEN TRUE END END AS value FROM g"),
    "evidence_enrich": (evidence_enrich, _ENRICH),
    "validate_status": (validate_status, f"{_STATUS} SELECT s_suppkey, status FROM st"),
    "validate_warnings": (validate_warnings, f"WITH w AS ({_WARN}) SELECT s_suppkey, warning FROM w"),
    "validate_counts": (validate_counts, f"{_STATUS} SELECT CAST(count_if(status <> 'failed') AS BIGINT) AS passed, CAST(count_if(status = 'warned') AS BIGINT) AS warned, CAST(count_if(status = 'failed') AS BIGINT) AS failed FROM st"),
    "override_apply": (override_apply, _OVERRIDE),
}
