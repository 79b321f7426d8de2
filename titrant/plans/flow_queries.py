"""Registered queries of what happens to records between scans and sinks: typed and raw properties, migration, repair, enrichment by vendors, proteins and classes, sources and sinks there and back."""

from __future__ import annotations

import json
import uuid
from importlib.resources import files

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import evidence, mining, rules, services
from ..schemas import FIRST_FLAGS, FLAGS, MANIFEST, NUMERICS, PROFILE, struct
from ..sources import buckets, documents, fetch, readers, search, sinks
from ..sources.folders import shared
from .common import Entry, quoted, spread, sql_values, table
from .corpus_queries import _RANK, ranked
from .ingest import handling_profiles, standard_rules
from .rule_queries import _STATUS, NUMBERS, TEXTS, _manifest_sql, applied, confidence_sql, fired_sql, flag_sql, manifest_index, supplier_records

P = "p_partkey"


def _folder(spark, name: str) -> str:
    return f"{shared(spark)}/{name}-{uuid.uuid4().hex}"


def _put(spark, folder: str, documents: dict[str, str]) -> None:
    """A few small files, written by the driver through the cluster's file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, body in documents.items():
        out = system.create(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))
        out.write(bytearray(body.encode()))
        out.close()


def _source(kind: str, ref: str, agrees: str) -> str:
    return f"named_struct('type', {kind}, 'ref', {ref}, 'agrees', CAST({agrees} AS BOOLEAN))"


def _flag(value: str, confidence: str, *sources: str) -> str:
    """A sourced flag as a Spark expression; a source may be null, and then isn't there."""
    none = "CAST(array() AS array<struct<type:string,ref:string,agrees:boolean>>)"
    return f"named_struct('value', CAST({value} AS BOOLEAN), 'confidence', {confidence}, 'sources', {'array_compact(array(' + ', '.join(sources) + '))' if sources else none})"


def _flags(**each: str) -> F.Column:
    return F.expr("map(" + ", ".join(f"'{k}', {v}" for k, v in each.items()) + ")").alias("flags")


def typed_rules(spark, sf_dir):
    """The standard rules over typed records: flat columns, numbers and sourced flags."""
    numbers = F.struct(*[F.expr(f"CAST({NUMBERS.get(n, 'NULL')} AS DOUBLE)").alias(n) for n in NUMERICS], F.expr(TEXTS["viscosity_class"]).alias("viscosity_class"), F.lit(None).cast("int").alias("freeze_thaw_max_cycles"))
    records = spread(table(spark, sf_dir, "part"), P).select(P, F.expr(TEXTS["physical_state"]).alias("physical_state"), numbers.alias("numerics"), _flags(**{f: _flag(flag_sql(i), confidence_sql(i)) for i, f in enumerate(FLAGS)}))
    return rules.fired_long(handling_profiles(records), P).select(P, "ord", "id", "confidence", "field_consensus")


def raw_values(spark, sf_dir):
    """A property of raw JSON that is bare, has a value inside, is null or isn't there."""
    doc = F.expr(f"""CASE {P} % 5 WHEN 0 THEN concat('{{"n": ', p_size, '}}') WHEN 1 THEN concat('{{"n": {{"value": ', 2 * p_size, ', "confidence": "high"}}}}') WHEN 2 THEN '{{"n": {{"value": null, "confidence": "low"}}}}' WHEN 3 THEN '{{"m": 1}}' ELSE '{{"n": null}}' END""")
    return table(spark, sf_dir, "part").select(P, rules.raw_value(F.parse_json(doc), "n", "int").alias("n"))


def profile_nested(spark, sf_dir):
    groups = applied(spark, sf_dir).select(P, F.explode(rules.nested_profile(F.col("profile"))).alias("directives", "inside"))
    return groups.select(P, "directives", F.explode("inside").alias("name", "value"))


_PROFILE = f"{fired_sql()}, last AS (SELECT p_partkey, path, arg_max(value, ord) AS value FROM fired JOIN write USING (ord) GROUP BY 1, 2)"


def _documents(spark, sf_dir) -> DataFrame:
    """Parts with the rules that fire, as the sinks take them."""
    return applied(spark, sf_dir).withColumns({"key": F.col(P).cast("string"), "name": F.col("p_name"), "cas": F.expr(f"CASE WHEN {P} % 3 = 0 THEN concat(p_size, '-00-1') END")})


def _read_documents(rows: DataFrame) -> DataFrame:
    d = rows.select("key", F.from_json("value", PROFILE).alias("d"))
    return d.select("key", "d.reagent_name", "d.cas", F.size("d.handling_profile").alias("n_groups"), F.size("d.rules_fired").alias("n_rules"), F.get("d.rules_fired", F.lit(0))["id"].alias("first_rule"), F.size("d.conflicts").alias("n_conflicts"))


_DOCUMENTS = f"""{_PROFILE}, g AS (SELECT p_partkey, count(DISTINCT split_part(path, '.', 1)) AS n FROM last GROUP BY 1), r AS (SELECT p_partkey, count(*) AS n, arg_min(id, ord) AS first_rule FROM fired GROUP BY 1)
SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS reagent_name, CASE WHEN p_partkey % 3 = 0 THEN p_size || '-00-1' END AS cas, CAST(coalesce(g.n, 0) AS INTEGER) AS n_groups, CAST(coalesce(r.n, 0) AS INTEGER) AS n_rules, first_rule, 0 AS n_conflicts
FROM part LEFT JOIN g USING (p_partkey) LEFT JOIN r USING (p_partkey)"""


def profile_documents(spark, sf_dir):
    return _read_documents(sinks.profile_documents(_documents(spark, sf_dir)))


def profiles_round_trip(spark, sf_dir):
    path = _folder(spark, "profiles")
    sinks.profiles(_documents(spark, sf_dir), path)
    return _read_documents(spark.read.schema("key string, value string").json(path))


def profile_files_round_trip(spark, sf_dir):
    """A file for each profile, over an older snapshot that goes, and read back."""
    path = _folder(spark, "profile-files")
    documents.write_documents(table(spark, sf_dir, "region").select(F.col("r_name").alias("key"), F.lit("stale").alias("value")), path)
    sinks.profile_files(_documents(spark, sf_dir), path)
    return _read_documents(documents.read_documents(spark, path))


def notes_write_back(spark, sf_dir):
    """Rules that fired become the record's notes; what was noted before goes."""
    out = sinks.with_rule_notes(applied(spark, sf_dir).withColumn("striking_fact", F.col("p_name")))
    assert not {"striking_fact", "rules_fired", "profile"} & set(out.columns)
    return out.select(P, F.posexplode("bench_knowledge").alias("place", "note")).select(P, "place", "note.rule_id", "note.confidence")


def migrate_flags(spark, sf_dir):
    """Two flags of the first version, and one that it had no place for."""
    bare = F.expr(f"map('is_protein', {flag_sql(0)}, 'is_volatile', {flag_sql(1)}, 'is_serum', true)")
    out = spread(table(spark, sf_dir, "part"), P).select(P, F.explode(evidence.migrate(bare)).alias("flag", "f"))
    return out.select(P, "flag", "f.value", "f.confidence", F.get("f.sources", F.lit(0))["ref"].alias("ref"), F.size("f.sources").alias("n_sources"))


_MIGRATE = f"""WITH {sql_values([(f, f in FIRST_FLAGS) for f in FLAGS], 'f', 'flag, early')}
SELECT p_partkey, flag, CASE flag WHEN 'is_protein' THEN {flag_sql(0)} WHEN 'is_volatile' THEN {flag_sql(1)} END AS value, 'low' AS confidence, 'not_yet_assessed' AS ref, 1 AS n_sources FROM part, f"""


def repair_provenance(spark, sf_dir):
    eye, burns = f"CASE WHEN {P} % 2 = 0 THEN {_source("'ghs_hcode'", "'H318'", 'true')} END", f"CASE WHEN {P} % 5 = 0 THEN {_source("'ghs_hcode'", "'H314'", 'p_size % 2 = 0')} END"
    legacy, role = _source("'claude_inference'", f"'{evidence.LEGACY}'", "true"), f"CASE WHEN {P} % 7 = 0 THEN {_source("'chebi'", "'R:1'", 'true')} END"
    third = lambda k: f"CASE ({P} + {k}) % 3 WHEN 0 THEN true WHEN 1 THEN false END"
    records = table(spark, sf_dir, "part").select(P, _flags(is_corrosive=_flag(third(0), "'high'", eye, burns), is_protein=_flag(third(1), "'medium'", legacy, role)))
    out = records.select(P, F.explode(evidence.repair(F.col("flags"), F.col(P) <= 10)).alias("flag", "f"))
    return out.select(P, "flag", "f.value", "f.confidence", F.array_join(F.transform("f.sources", lambda s: F.concat_ws(":", s["ref"], s["agrees"].cast("string"))), "|").alias("refs"))


_THIRD = "CASE (p_partkey + {}) % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END"
_REPAIR = f"""WITH p AS (SELECT p_partkey, p_size % 2 = 0 AS yes, p_partkey % 2 = 0 AS eye, p_partkey % 5 = 0 AS burns, p_partkey % 7 = 0 AS role, p_partkey <= 10 AS early, {_THIRD.format(0)} AS c, {_THIRD.format(1)} AS b FROM part)
SELECT p_partkey, 'is_corrosive' AS flag, CASE WHEN eye AND NOT (burns AND yes) AND coalesce(c, FALSE) THEN NULL ELSE c END AS value, CASE WHEN NOT eye THEN 'high' WHEN burns AND yes THEN 'high' ELSE 'low' END AS confidence, CASE WHEN burns THEN 'H314:' || CAST(yes AS VARCHAR) ELSE '' END AS refs FROM p
UNION ALL SELECT p_partkey, 'is_protein', b, CASE WHEN early AND coalesce(b, FALSE) THEN 'medium' WHEN role THEN 'high' ELSE 'low' END, CASE WHEN early THEN 'legacy_handauthored_mvp:' || CAST(coalesce(b, FALSE) AS VARCHAR) ELSE 'not_yet_assessed:false' END || CASE WHEN role THEN '|R:1:true' ELSE '' END FROM p"""

#: A vendor's page of every third part, as expressions of both engines.
VENDOR = {
    "cat_base": f"CASE WHEN {P} % 4 <> 0 THEN concat('M', {P}) END", "storage_temp": f"CASE WHEN {P} % 5 = 0 THEN '' ELSE concat('-', p_size, ' C') END", "glycerol_pct": f"CASE WHEN {P} % 2 = 0 THEN p_size END",
    "heat_inactivate": f"CASE WHEN {P} % 6 < 3 THEN '65 C for 20 min' ELSE '' END", "notes": f"CASE {P} % 9 WHEN 0 THEN 'Lasts about thirty cycles of freezing, not more.' WHEN 3 THEN '' END",
}


def vendor_enrich(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    notes = F.expr(f"CASE WHEN {P} % 4 = 1 THEN array(named_struct('rule_id', 'r', 'because', 'HEAT it first', 'cite', 'c', 'confidence', 'low')) WHEN {P} % 4 = 3 THEN array(named_struct('rule_id', 'r', 'because', 'Lasts about thirty cycles of freezing: so they say', 'cite', 'c', 'confidence', 'low')) END")
    records = parts.select(
        F.col(P).cast("string").alias("key"), _flags(requires_ice=_flag(f"CASE {P} % 4 WHEN 0 THEN true WHEN 1 THEN false END", "'low'")), F.struct(F.lit(5.0).alias("glycerol_pct")).alias("numerics"),
        F.struct(F.expr(f"CASE {P} % 3 WHEN 0 THEN CASE WHEN p_size % 2 = 0 THEN 'As before' ELSE '' END ELSE 'Cold' END").alias("storage")).alias("sds_facts"), notes.alias("bench_knowledge"),
    )
    lookup = parts.filter(f"{P} % 3 = 0").select(F.col(P).cast("string").alias("slug"), *[F.expr(e).alias(c) for c, e in VENDOR.items()])
    out = evidence.enrich_vendor(records, lookup)
    flag = lambda n: F.try_element_at("flags", F.lit(n))
    return out.select(
        "key", flag("requires_ice")["value"].alias("ice"), flag("requires_ice")["confidence"].alias("ice_confidence"), F.get(flag("requires_ice")["sources"], F.lit(0))["ref"].alias("ice_ref"), flag("lo_bind_required")["value"].alias("lo_bind"),
        F.array_join(F.transform(flag("lo_bind_required")["sources"], lambda s: s["ref"]), "|").alias("lo_bind_refs"), F.col("numerics.glycerol_pct").alias("glycerol_pct"), F.col("sds_facts.storage").alias("storage"), F.array_join(F.transform(F.coalesce("bench_knowledge", F.array()), lambda n: F.substring(n["because"], 1, 8)), "|").alias("notes"),
    )


_VENDOR = f"""WITH v AS (SELECT p_partkey, p_partkey % 3 = 0 AS hit, p_size, CASE p_partkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS old_ice, {', '.join(f'CASE WHEN p_partkey % 3 = 0 THEN {e} END AS {c}' for c, e in VENDOR.items())} FROM part),
w AS (SELECT *, hit AND coalesce(storage_temp, '') <> '' AS cold, coalesce(cat_base, 'unknown') AS page, CASE WHEN NOT hit THEN 'Cold' WHEN p_size % 2 = 0 THEN 'As before' ELSE '' END AS was FROM v)
SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN cold THEN coalesce(old_ice, TRUE) ELSE old_ice END AS ice, CASE WHEN cold THEN 'medium' ELSE 'low' END AS ice_confidence, CASE WHEN cold THEN 'neb.com/products/' || page || ':storage_temp:' || replace(storage_temp, ' ', '') END AS ice_ref,
CASE WHEN hit THEN TRUE END AS lo_bind, CASE WHEN hit THEN 'not_yet_assessed|neb.com/products/' || page || ':enzyme_protein_adsorption' END AS lo_bind_refs, CAST(coalesce(glycerol_pct, 5.0) AS DOUBLE) AS glycerol_pct,
coalesce(nullif(was, ''), CASE WHEN cold THEN 'Store at ' || storage_temp || '.' || CASE WHEN glycerol_pct IS NULL THEN '' ELSE ' 50 mM KPO4, ' || CAST(glycerol_pct AS VARCHAR) || '% glycerol.' END END, was) AS storage,
concat_ws('|', CASE p_partkey % 4 WHEN 1 THEN 'HEAT it ' WHEN 3 THEN 'Lasts ab' END, CASE WHEN hit AND heat_inactivate <> '' AND p_partkey % 4 <> 1 THEN 'Heat ina' END, CASE WHEN hit AND coalesce(notes, '') <> '' AND p_partkey % 4 <> 3 THEN 'Lasts ab' END) AS notes FROM w"""


def protein_names(spark, sf_dir):
    """The searches for a protein of three kinds of names, in order."""
    name = F.expr(f"CASE {P} % 3 WHEN 0 THEN concat('Recombinant Human ', split(p_name, ' ')[1], '-α', p_size) WHEN 1 THEN concat('his-tagged  ', p_name, ' protein factor (biotinylated)') ELSE p_name END")
    out = spread(table(spark, sf_dir, "part"), P).select(P, text.clean_protein_name(name).alias("clean"), F.posexplode(text.protein_queries(name)).alias("place", "q"))
    return out.select(P, "clean", "place", "q.label", "q.query")


_PROTEIN = """WITH c AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN split_part(p_name, ' ', 2) || '-A' || p_size WHEN 1 THEN p_name || ' protein factor ( )' ELSE p_name END AS clean FROM part),
g AS (SELECT *, replace(upper(clean), ' ', '') AS gene, length(replace(clean, ' ', '')) BETWEEN 2 AND 12 AS short FROM c),
q AS (SELECT p_partkey, clean, 0 AS place, 'gene_human' AS label, 'gene:' || gene || ' AND reviewed:true AND organism_id:9606' AS query FROM g WHERE short
UNION ALL SELECT p_partkey, clean, 1, 'name_exact', 'protein_name:"' || clean || '" AND reviewed:true AND organism_id:9606' FROM g WHERE short
UNION ALL SELECT p_partkey, clean, 2, 'gene_any', 'gene:' || gene || ' AND reviewed:true' FROM g WHERE short
UNION ALL SELECT p_partkey, clean, 3, 'gene_nohyphen', 'gene:' || replace(gene, '-', '') || ' AND reviewed:true AND organism_id:9606' FROM g WHERE short AND contains(gene, '-') AND length(replace(gene, '-', '')) <= 10
UNION ALL SELECT p_partkey, clean, 0, 'name_exact', 'protein_name:"' || clean || '" AND reviewed:true' FROM g WHERE NOT short
UNION ALL SELECT p_partkey, clean, 1, 'name_partial', 'protein_name:"' || split_part(clean, ' ', 1) || ' ' || split_part(clean, ' ', 2) || ' ' || split_part(clean, ' ', 3) || '" AND reviewed:true' FROM g WHERE NOT short AND len(string_split(clean, ' ')) >= 3)
SELECT * FROM q"""


def protein_enrich(spark, sf_dir):
    """Records of both versions with a protein database's hits; those of the first version are passed over."""
    parts = table(spark, sf_dir, "part")
    records = parts.select(F.col(P).alias("key"), F.expr(f"CASE WHEN {P} % 6 = 0 THEN '1.0' ELSE '2.0' END").alias("schema_version"), _flags(is_protein=_flag(flag_sql(0), "'medium'", f"CASE WHEN {P} % 5 = 0 THEN {_source("'uniprot'", f"concat('uniprot:Q', {P})", 'false')} END")))
    hits = parts.select(F.col(P).alias("key"), F.expr(f"CASE WHEN {P} % 4 <> 0 THEN concat('Q', {P}) END").alias("accession"))
    out = evidence.enrich(records, evidence.protein_evidence(hits)).select("key", F.explode("flags").alias("flag", "f"))
    return out.select("key", "flag", "f.value", "f.confidence", F.array_join(F.transform("f.sources", lambda s: s["ref"]), "|").alias("refs"))


_PROTEIN_FLAGS = f"""WITH p AS (SELECT p_partkey AS key, p_partkey % 4 <> 0 AND p_partkey % 6 <> 0 AS hit, p_partkey % 5 = 0 AS old, {flag_sql(0)} AS v FROM part)
SELECT key, 'is_protein' AS flag, CASE WHEN hit AND NOT old THEN coalesce(v, TRUE) ELSE v END AS value, CASE WHEN hit AND NOT old THEN 'high' ELSE 'medium' END AS confidence, CASE WHEN hit OR old THEN 'uniprot:Q' || key ELSE '' END AS refs FROM p
UNION ALL SELECT key, 'lo_bind_required', TRUE, 'high', 'not_yet_assessed|uniprot:Q' || key FROM p WHERE hit"""


def light_sensitive_corollary(spark, sf_dir):
    records = table(spark, sf_dir, "part").select(P, F.expr(f"""map_concat(map('is_fluorophore', {_flag(flag_sql(4), confidence_sql(4))}), CASE WHEN {P} % 2 = 0 THEN map('is_light_sensitive', {_flag(f"CASE {P} % 3 WHEN 0 THEN true WHEN 1 THEN false END", "'high'")}) ELSE CAST(map() AS map<string,struct<value:boolean,confidence:string,sources:array<struct<type:string,ref:string,agrees:boolean>>>>) END)""").alias("flags"))
    child = F.try_element_at(evidence.sync_light_sensitive(F.col("flags")), F.lit("is_light_sensitive"))
    return records.select(P, child["value"].alias("value"), child["confidence"].alias("confidence"), F.array_join(F.transform(child["sources"], lambda s: s["ref"]), "|").alias("refs"))


_COROLLARY = f"""WITH p AS (SELECT p_partkey, p_partkey % 2 = 0 AS there, coalesce({flag_sql(4)}, FALSE) AS dye, {confidence_sql(4)} AS c, CASE WHEN p_partkey % 2 = 0 THEN CASE p_partkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END END AS v FROM part)
SELECT p_partkey, CASE WHEN dye THEN coalesce(v, TRUE) ELSE v END AS value, CASE WHEN dye THEN coalesce(c, 'low') WHEN there THEN 'high' END AS confidence, CASE WHEN dye THEN CASE WHEN there THEN '' ELSE 'not_yet_assessed|' END || '{evidence.DERIVED_LIGHT}' WHEN there THEN '' END AS refs FROM p"""


def biologic_targets(spark, sf_dir):
    """Records that a protein search is for."""
    records = table(spark, sf_dir, "part").select(F.expr(f"CASE WHEN {P} % 4 = 0 THEN concat(p_size, '-', {P}) ELSE concat('part-', {P}) END").alias("key"), F.expr(f"CASE {P} % 3 WHEN 0 THEN '1-11-1' WHEN 1 THEN '' END").alias("cas"), _flags(is_protein=_flag("true", "'low'", f"CASE WHEN {P} % 5 = 0 THEN {_source("'manufacturer_protocol'", "'x'", 'true')} END")))
    return evidence.without_vendor_evidence(records).select("key")


def source_forms(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(P, F.concat(F.lit("  "), "p_brand", F.lit(" \t "), F.upper("p_type"), F.lit(" ")).alias("raw"))
    return p.select(P, text.normalize_source(F.col("raw")).alias("source"), text.normalize_identifier(F.col("raw")).alias("identifier"))


def annual_json(spark, sf_dir):
    return mining.for_csv(ranked(spark, sf_dir)).select("normalized_name", "annual_counts")


def count_sorted(spark, sf_dir):
    """The first parts by a count written as text, with their places."""
    rows = table(spark, sf_dir, "part").select(F.expr(f"CASE {P} % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN '' ELSE CAST(p_size AS STRING) END").alias("n"), P)
    return mining.sort_by_count(rows, "n", 50).select(P, "n")


def enrich_counters(spark, sf_dir):
    """Users whose even days show kinds of events that their odd days don't."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", (F.dayofyear("ts") % 2 == 1).alias("odd"))
    g = e.groupBy("user_id").agg(F.collect_set(F.when(F.col("odd"), F.col("event_type"))).alias("old"), F.collect_set(F.when(~F.col("odd") & (F.col("user_id") % 3 != 0), F.col("event_type"))).alias("new"))
    return g.agg(*services.change_counts(F.col("old"), F.col("new")))


_COUNTERS = """WITH e AS (SELECT DISTINCT user_id, event_type, dayofyear(ts) % 2 = 1 AS odd FROM events), n AS (SELECT user_id, event_type FROM e WHERE NOT odd AND user_id % 3 <> 0 EXCEPT SELECT user_id, event_type FROM e WHERE odd)
SELECT (SELECT count(DISTINCT user_id) FROM events) AS seen, (SELECT count(DISTINCT user_id) FROM n) AS changed, (SELECT count(*) FROM n) AS changes"""


def validate_errors(spark, sf_dir):
    """Errors in order of their place in the record."""
    return evidence.validate(supplier_records(spark, sf_dir)).filter("status = 'failed'").select("s_suppkey", F.array_join("errors", "|").alias("errors"))


_ERRORS = f"{_STATUS} SELECT s_suppkey, concat_ws('|', CASE WHEN s_suppkey % 11 = 0 THEN 'name: missing' END, CASE WHEN s_suppkey % 13 = 0 THEN 'physical_state: not allowed' END, CASE WHEN s_suppkey % 9 = 0 THEN 'schema_version: not 2.0' END) AS errors FROM supplier JOIN st USING (s_suppkey) WHERE status = 'failed'"


# Sources and sinks.


def records_round_trip(spark, sf_dir):
    """Typed records written as rows of JSON and read again."""
    records, path = supplier_records(spark, sf_dir), _folder(spark, "records")
    sinks.records(records, path)
    return spark.read.schema(records.schema).json(path).select("s_suppkey", "name", "schema_version", F.explode("flags").alias("flag", "f")).select("s_suppkey", "name", "schema_version", "flag", "f.value", "f.confidence", F.size("f.sources").alias("n_sources"))


_RECORDS = "WITH " + sql_values([(i, f) for i, (_, f) in enumerate(evidence.INVARIANTS)], "f", "i, flag") + """
SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE s_name END AS name, CASE WHEN s_suppkey % 9 = 0 THEN '1.0' ELSE '2.0' END AS schema_version, flag, CASE WHEN s_nationkey % (i + 2) = 0 THEN TRUE END AS value, CASE s_suppkey % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS confidence, 1 AS n_sources FROM supplier, f"""


def documents_scan(spark, sf_dir):
    """One document a file, pretty-printed, whose name is its key; the same files as raw JSON, with bare or sourced values."""
    rows = table(spark, sf_dir, "nation").collect()
    folder = _folder(spark, "documents")
    _put(spark, folder, {f"nation.{r.n_nationkey}.json": json.dumps({"name": r.n_name, "cas": str(r.n_regionkey), "size": {"value": r.n_nationkey} if r.n_nationkey % 2 else r.n_nationkey}, indent=2) for r in rows})
    typed = readers.json_documents(spark, folder, struct(key=MANIFEST["pmcid"].dataType, name=MANIFEST["pmcid"].dataType, cas=MANIFEST["pmcid"].dataType))
    raw = readers.raw_documents(spark, folder).select("key", rules.raw_value(F.col("doc"), "size", "int").alias("size"))
    return typed.join(raw, "key").select("key", "name", "cas", "size")


def sheet_scan(spark, sf_dir):
    """Texts of sheets, one a file; a blank one stays."""
    rows = table(spark, sf_dir, "nation").collect()
    folder = _folder(spark, "sheets")
    _put(spark, folder, {f"{r.n_name}.txt": " " if r.n_nationkey % 6 == 0 else f"page of {r.n_name}\n\nnext page" for r in rows})
    return readers.sheet_texts(spark, folder)


def yaml_rules(spark, sf_dir):
    path = str(files("titrant") / "data" / "rules.yaml")
    kind = MANIFEST["pmcid"].dataType
    return readers.yaml_table(spark, path, struct(id=kind, cite=kind), "id")


def csv_round_trip(spark, sf_dir):
    """Cells with quotes, commas, line breaks and words for missing, written and read as text."""
    path = _folder(spark, "csv")
    rows = table(spark, sf_dir, "part").select(F.col(P).cast("string").alias("k"), F.expr(f"""CASE {P} % 6 WHEN 0 THEN 'N/A' WHEN 1 THEN concat(p_name, ', "', p_brand, '"') WHEN 2 THEN concat(p_name, '\\n', p_type) WHEN 3 THEN 'none' WHEN 4 THEN '' ELSE p_type END""").alias("cell"))
    sinks.csv(rows, path)
    a, b = (readers.csv_text(spark, path, ["k", "cell"], blank) for blank in (True, False))
    return a.join(b.withColumnRenamed("cell", "as_written"), "k")


_CSV = """WITH c AS (SELECT CAST(p_partkey AS VARCHAR) AS k, CASE p_partkey % 6 WHEN 0 THEN 'N/A' WHEN 1 THEN p_name || ', "' || p_brand || '"' WHEN 2 THEN p_name || chr(10) || p_type WHEN 3 THEN 'none' WHEN 4 THEN '' ELSE p_type END AS w FROM part) SELECT k, CASE WHEN w = 'N/A' THEN '' ELSE w END AS cell, w AS as_written FROM c"""


def manifest_scan(spark, sf_dir):
    """A papers' manifest as CSV, with the words for missing kept; one that isn't there adds nothing."""
    path = _folder(spark, "manifest")
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("pmcid"), F.lit("J").alias("journal"), F.lit("2020").alias("year"), F.expr("CASE WHEN toxic = 1 THEN 'N/A' ELSE 'a title' END").alias("title"), F.expr("CASE quality WHEN 1 THEN 'True' ELSE '' END").alias("has_xml"), F.lit("yes").alias("fetch_ok"))
    sinks.csv(rows, path)
    return readers.manifest(spark, path).unionByName(readers.manifest(spark, f"{path}-absent"))


def index_round_trip(spark, sf_dir):
    """The published index, and each entry's place in it."""
    path = _folder(spark, "index")
    sinks.index(manifest_index(spark, sf_dir), path)
    lines = spark.read.text(path).select(F.regexp_replace(F.regexp_replace("value", r"\A[\[,]", ""), r"\]\z", "").alias("v"))
    return lines.select(F.from_json("v", "name string, cas string, category string, top_pictogram string, signal_word string, summary_fact string, rules_fired_count int, file string").alias("e")).select("e.*")


def mirrors_round_trip(spark, sf_dir):
    """One snapshot in three places, over what was there before."""
    paths = [_folder(spark, f"mirror-{i}") for i in range(3)]
    sinks.mirrors(table(spark, sf_dir, "region").select(F.lit(-1).alias("n_nationkey"), F.lit("stale").alias("n_name")), paths[1])
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sinks.mirrors(rows, *paths)
    return spark.read.schema(rows.schema).json(paths).groupBy("n_nationkey", "n_name").agg(F.count("*").alias("n_places"))


def kept_snapshot(spark, sf_dir):
    """Suppliers without those that a verdict drops."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("slug"), "s_name")
    verdicts = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("slug"), F.expr("CASE WHEN quality = 1 THEN 'drop' ELSE 'keep' END").alias("verdict"))
    return sinks.kept(s, verdicts)


def cache_round_trip(spark, sf_dir):
    """A cache of answers with newer ones over older; a miss is remembered."""
    path = _folder(spark, "cache")
    c = table(spark, sf_dir, "customer")
    sinks.cache(c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("key"), F.lit("old").alias("v")), c.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("key"), F.expr("CASE WHEN c_custkey % 4 <> 0 THEN c_name END").alias("v")), path)
    return spark.read.parquet(path).select("key", "v")


def cache_upsert(spark, sf_dir):
    """A cache of all customers, some of them misses; then what their orders say goes over it, twice."""
    path = _folder(spark, "buckets")
    buckets.upsert(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.expr("CASE WHEN c_acctbal > 0 THEN c_mktsegment END").alias("v")), path, buckets=32)
    found = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.max("o_orderpriority").alias("v"))
    buckets.upsert(found, path)
    again = buckets.upsert(found, path)
    return buckets.entries(spark, path).select("key", "v", F.lit(len(again)).cast("long").alias("n_again"))


_LITERATURE = "literature"


def search_hits(spark, sf_dir):
    """The paged search without a network: a journal of each region, with as many papers as its key says."""
    spark.dataSource.register(search.LiteratureSource)
    journals = {r.r_name: [f"{5 * r.r_regionkey}-0001"] for r in table(spark, sf_dir, "region").collect()}
    return spark.read.format(_LITERATURE).option("journals", json.dumps(journals)).option("transport", "titrant.sources.offline:pages").load()


_SEARCH = "SELECT r_name AS journal, 'PMC' || (5 * r_regionkey) || 'x' || i AS pmcid, CAST(2000 + i AS VARCHAR) AS year, CASE WHEN i % 2 = 1 THEN substr(repeat('Paper ' || i || ' ', 30), 1, 200) ELSE 'Paper ' || i || ' ' END AS title FROM region, range(0, 20) t(i) WHERE i < 5 * r_regionkey"


def article_fetch(spark, sf_dir):
    """Articles of orders' customers, some of which an earlier run fetched."""
    cache = _folder(spark, "articles")
    ids = table(spark, sf_dir, "customer").select(F.concat(F.lit("PMC"), F.col("c_custkey").cast("string")).alias("pmcid"), "c_custkey")
    fetch.fetch(ids.filter("c_custkey % 2 = 0"), cache, "titrant.sources.offline:article", 0.0).count()
    return fetch.fetch(ids, cache, "titrant.sources.offline:article", 0.0)


_FETCHED = "c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 11 <> 0"


def cache_sweep(spark, sf_dir):
    """A cache with what was written before bodies were checked, swept."""
    cache, swept = _folder(spark, "unswept"), _folder(spark, "swept")
    p = table(spark, sf_dir, "part")
    good = F.concat(F.lit("<article>"), F.repeat(F.concat(F.lit("<p>"), "p_name", F.lit("</p>")), 30), F.lit("</article>"))
    p.select(F.col(P).cast("string").alias("pmcid"), F.when(F.col(P) % 4 == 0, F.substring(good, 1, 220)).when(F.col(P) % 9 == 1, F.lit("<article/>")).when(F.col(P) % 9 == 2, F.replace(good, F.lit("article"), F.lit("html"))).otherwise(good).cast("binary").alias("xml")).write.parquet(cache)
    counts = fetch.sweep(spark, cache, swept)
    return counts.select("n_valid", "n_removed", F.lit(spark.read.parquet(swept).count()).alias("n_left"))


ENTRIES: dict[str, Entry] = {
    "typed_rules": (typed_rules, f"{fired_sql()} SELECT p_partkey, ord, id, confidence, field_consensus FROM fired"),
    "raw_values": (raw_values, "SELECT p_partkey, CAST(CASE p_partkey % 5 WHEN 0 THEN p_size WHEN 1 THEN 2 * p_size END AS INTEGER) AS n FROM part"),
    "profile_nested": (profile_nested, f"{_PROFILE} SELECT p_partkey, split_part(path, '.', 1) AS directives, split_part(path, '.', 2) AS name, value FROM last"),
    "profile_documents": (profile_documents, _DOCUMENTS),
    "profiles_round_trip": (profiles_round_trip, _DOCUMENTS),
    "profile_files_round_trip": (profile_files_round_trip, _DOCUMENTS),
    "notes_write_back": (notes_write_back, f"{fired_sql()} SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY ord) - 1 AS INTEGER) AS place, id AS rule_id, confidence FROM fired"),
    "migrate_flags": (migrate_flags, _MIGRATE),
    "repair_provenance": (repair_provenance, _REPAIR),
    "vendor_enrich": (vendor_enrich, _VENDOR),
    "protein_names": (protein_names, _PROTEIN),
    "protein_enrich": (protein_enrich, _PROTEIN_FLAGS),
    "light_sensitive_corollary": (light_sensitive_corollary, _COROLLARY),
    "biologic_targets": (biologic_targets, "SELECT 'part-' || p_partkey AS key FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 3 <> 0 AND p_partkey % 5 <> 0"),
    "source_forms": (source_forms, "SELECT p_partkey, lower(p_brand || ' ' || p_type) AS source, upper(p_brand || ' ' || p_type) AS identifier FROM part"),
    "annual_json": (annual_json, f"WITH {_RANK.format(where='')} SELECT n AS normalized_name, '{{' || string_agg('\"' || y || '\":' || c, ',' ORDER BY y) || '}}' AS annual_counts FROM ny JOIN t USING (n) WHERE total >= 5 GROUP BY 1"),
    "count_sorted": (count_sorted, "WITH c AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'n/a' WHEN 1 THEN '' ELSE CAST(p_size AS VARCHAR) END AS n FROM part) SELECT p_partkey, n FROM c ORDER BY coalesce(TRY_CAST(n AS BIGINT), 0) DESC, p_partkey LIMIT 50"),
    "enrich_counters": (enrich_counters, _COUNTERS),
    "validate_errors": (validate_errors, _ERRORS),
    "records_round_trip": (records_round_trip, _RECORDS),
    "documents_scan": (documents_scan, "SELECT 'nation.' || n_nationkey AS key, n_name AS name, CAST(n_regionkey AS VARCHAR) AS cas, n_nationkey AS size FROM nation"),
    "sheet_scan": (sheet_scan, "SELECT n_name AS key, CASE WHEN n_nationkey % 6 = 0 THEN ' ' ELSE 'page of ' || n_name || chr(10) || chr(10) || 'next page' END AS text FROM nation"),
    "yaml_rules": (yaml_rules, "SELECT * FROM (VALUES " + ", ".join(f"({quoted(r.id)}, {quoted(r.cite)})" for r in standard_rules()) + ") r(id, cite)"),
    "csv_round_trip": (csv_round_trip, _CSV),
    "manifest_scan": (manifest_scan, "SELECT CAST(doc_id AS VARCHAR) AS pmcid, 'J' AS journal, '2020' AS year, CASE WHEN toxic = 1 THEN 'N/A' ELSE 'a title' END AS title, CASE quality WHEN 1 THEN 'True' ELSE '' END AS has_xml, 'yes' AS fetch_ok FROM labels"),
    "index_round_trip": (index_round_trip, _manifest_sql()),
    "mirrors_round_trip": (mirrors_round_trip, "SELECT n_nationkey, n_name, CAST(3 AS BIGINT) AS n_places FROM nation"),
    "kept_snapshot": (kept_snapshot, "SELECT s_suppkey AS slug, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT doc_id FROM labels WHERE quality = 1)"),
    "cache_round_trip": (cache_round_trip, "SELECT c_custkey AS key, CASE WHEN c_custkey % 3 <> 0 THEN 'old' WHEN c_custkey % 4 <> 0 THEN c_name END AS v FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0"),
    "cache_upsert": (cache_upsert, "WITH o AS (SELECT o_custkey AS key, max(o_orderpriority) AS v FROM orders GROUP BY 1) SELECT key, v, CAST(0 AS BIGINT) AS n_again FROM o UNION ALL SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_mktsegment END, 0 FROM customer WHERE c_custkey NOT IN (SELECT key FROM o)"),
    "search_hits": (search_hits, _SEARCH),
    "article_fetch": (article_fetch, f"SELECT 'PMC' || c_custkey AS pmcid, CASE WHEN NOT ({_FETCHED}) THEN 'miss' WHEN c_custkey % 2 = 0 THEN 'cached' ELSE 'ok' END AS status FROM customer"),
    "cache_sweep": (cache_sweep, "WITH p AS (SELECT p_partkey % 4 <> 0 AND p_partkey % 9 NOT IN (1, 2) AS ok FROM part) SELECT count_if(ok) AS n_valid, count_if(NOT ok) AS n_removed, count_if(ok) AS n_left FROM p"),
}
