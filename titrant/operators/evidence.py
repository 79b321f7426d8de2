"""Evidence fusion: sources of many kinds per flag become a value with a recomputed confidence.

Sources live in records as arrays, or as long rows (``key, flag, type, ref, agrees, ord``). Both forms have the same
operators; the long form aggregates with partial aggregation on ``key, flag``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.first_match import blank_to_null, first_match
from ..functions.text import lookup_key
from ..schemas import FIRST_FLAGS, FLAGS, SOURCED, TIERS
from .lookups import one_per_key

NOT_ASSESSED = "not_yet_assessed"
SOURCES_TYPE = "array<struct<type:string,ref:string,agrees:boolean>>"


def tier(kind: Column) -> Column:
    return first_match([(kind.isin(*[k for k, v in TIERS.items() if v == t]), t) for t in ("high", "medium", "inherit")], "low")


def _verdict(high_yes: Column, high_no: Column, medium_yes: Column) -> Column:
    return F.when(high_yes & ~high_no, "high").when((medium_yes & ~high_no) | (high_yes & high_no), "medium").otherwise("low")


def confidence(sources: Column) -> Column:
    """Of an array of sources. High evidence that agrees decides unless high evidence disagrees; inherited sources don't count."""
    among = lambda t, yes: F.coalesce(F.exists(sources, lambda s: (tier(s["type"]) == t) & (F.coalesce(s["agrees"], F.lit(True)) == F.lit(yes))), F.lit(False))
    return _verdict(among("high", True), among("high", False), among("medium", True))


def confidence_long(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys, confidence`` of long rows."""
    agrees = F.coalesce("agrees", F.lit(True))
    t = tier(F.col("type"))
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    return rows.groupBy(*keys).agg(_verdict(some((t == "high") & agrees), some((t == "high") & ~agrees), some((t == "medium") & agrees)).alias("confidence"))


def inherited_confidence(sources: Column, flags: Column) -> Column:
    """Confidence for validation: a flag that rests on a derivation alone takes that of the flag it is derived from."""
    derived = F.filter(sources, lambda s: (tier(s["type"]) == "inherit") & s["ref"].contains("→"))
    has_derived = F.coalesce(F.exists(sources, lambda s: tier(s["type"]) == "inherit"), F.lit(False))
    substantive = F.coalesce(F.exists(sources, lambda s: tier(s["type"]).isin("high", "medium")), F.lit(False))
    parents = F.transform(derived, lambda s: F.try_element_at(flags, F.regexp_extract(s["ref"], r"([A-Za-z_]+)\s*→", 1))["confidence"])
    parent = F.get(F.array_compact(parents), F.lit(0))
    return F.when(has_derived & ~substantive, F.coalesce(parent, confidence(sources))).otherwise(confidence(sources))


def placeholder(value: Column | None = None) -> Column:
    value = F.lit(None).cast("boolean") if value is None else value
    source = F.struct(F.lit("claude_inference").alias("type"), F.lit(NOT_ASSESSED).alias("ref"), F.lit(False).alias("agrees"))
    return F.struct(value.alias("value"), F.lit("low").alias("confidence"), F.array(source).alias("sources"))


def union_sources(old: Column, new: Column) -> Column:
    """Old sources, then new ones whose type and reference are not there yet; the first writer's verdict stays."""
    none = F.array().cast(SOURCES_TYPE)
    every = F.concat(F.coalesce(old, none), F.coalesce(new, none))
    return F.reduce(every, none, lambda acc, s: F.when(F.exists(acc, lambda t: t["type"].eqNullSafe(s["type"]) & t["ref"].eqNullSafe(s["ref"])), acc).otherwise(F.concat(acc, F.array(s))))


def union_long(rows: DataFrame, keys: Sequence[str] = ("key", "flag"), order: Sequence[str] = ("ord",)) -> DataFrame:
    """Long rows without later repeats of a type and reference."""
    return one_per_key(rows, [*keys, "type", "ref"], [F.col(c) for c in order])


def settled_value(value: Column, new_agrees: Column) -> Column:
    """New agreeing evidence makes an unknown value true; it never changes a known one."""
    return F.coalesce(value, F.when(F.coalesce(new_agrees, F.lit(False)), F.lit(True)))


PRESENT = "2.0"


def enrich(records: DataFrame, evidence: DataFrame, key: str = "key", flags: str = "flags", version: str | None = "schema_version") -> DataFrame:
    """Records with long ``evidence`` (``key, flag, type, ref, agrees, ord``) fused into their flags, in one join.

    The evidence is gathered per record: its rows are bounded by the patterns and look-ups that make them. Records whose
    column ``version`` (if they have it) isn't the present one are passed over: they come out as they went in.
    """
    per_flag = evidence.groupBy(key, "flag").agg(F.array_sort(F.collect_list(F.struct("ord", "type", "ref", "agrees"))).alias("rows"))
    per_flag = per_flag.select(key, F.struct(F.col("flag").alias("key"), F.transform("rows", lambda r: F.struct(r["type"].alias("type"), r["ref"].alias("ref"), r["agrees"].alias("agrees"))).alias("value")).alias("e"))
    gathered = per_flag.groupBy(key).agg(F.map_from_entries(F.collect_list("e")).alias("__new"))
    out = records.join(gathered, key, "left")
    names = F.array_distinct(F.concat(F.map_keys(F.coalesce(flags, F.create_map().cast("map<string,struct<value:boolean,confidence:string,sources:" + SOURCES_TYPE + ">>"))), F.coalesce(F.map_keys("__new"), F.array().cast("array<string>"))))

    def fused(name: Column) -> Column:
        old, new = F.try_element_at(flags, name), F.try_element_at("__new", name)
        base = F.coalesce(old, placeholder())
        sources = union_sources(base["sources"], new)
        value = settled_value(base["value"], F.exists(new, lambda s: F.coalesce(s["agrees"], F.lit(True))))
        grown = F.struct(value.alias("value"), confidence(sources).alias("confidence"), sources.alias("sources"))
        return F.when(new.isNull() | (F.size(sources) == F.size(base["sources"])), base).otherwise(grown)

    grown = F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), fused(n).alias("value"))))
    if version in records.columns:
        grown = F.when(F.coalesce(F.col(version) == PRESENT, F.lit(False)), grown).otherwise(F.col(flags))
    return out.withColumn(flags, grown).drop("__new")


def role_evidence(records: DataFrame, lookup: DataFrame, key: str = "key", cas: str = "cas", strict_keys: bool = False) -> DataFrame:
    """Evidence from class roles. ``lookup``: ``cas, chebi_id, roles ARRAY<STRUCT<term, role_chebi, flag, agrees>>``, small by nature."""
    rows = records.select(key, lookup_key(F.col(cas), strict_keys).alias("__cas")).join(lookup.select(F.col("cas").alias("__cas"), "chebi_id", F.posexplode("roles").alias("ord", "role")), "__cas")
    ref = F.coalesce(blank_to_null(F.col("role.role_chebi")), F.concat(blank_to_null(F.col("chebi_id")), F.lit(":"), F.col("role.term")), F.col("role.term"))
    return rows.filter("role.flag IS NOT NULL").select(key, F.col("role.flag").alias("flag"), F.lit("chebi").alias("type"), ref.alias("ref"), F.coalesce("role.agrees", F.lit(True)).alias("agrees"), "ord")


DERIVED_LIGHT = "rule_derived:is_fluorophore→is_light_sensitive"


def sync_light_sensitive(flags: Column) -> Column:
    """A fluorophore is light-sensitive, with the confidence that it is a fluorophore."""
    parent, child = F.try_element_at(flags, F.lit("is_fluorophore")), F.coalesce(F.try_element_at(flags, F.lit("is_light_sensitive")), placeholder())
    source = F.struct(F.lit("rule_derived").alias("type"), F.lit(DERIVED_LIGHT).alias("ref"), F.lit(True).alias("agrees"))
    there = F.exists(child["sources"], lambda s: (s["type"] == "rule_derived") & (s["ref"] == DERIVED_LIGHT))
    value = F.when(there, child["value"]).otherwise(F.coalesce(child["value"], F.lit(True)))
    after = F.struct(value.alias("value"), F.coalesce(parent["confidence"], F.lit("low")).alias("confidence"), union_sources(child["sources"], F.array(source)).alias("sources"))
    rest = F.filter(F.map_entries(flags), lambda e: e["key"] != "is_light_sensitive")
    changed = F.map_from_entries(F.concat(rest, F.array(F.struct(F.lit("is_light_sensitive").alias("key"), after.alias("value")))))
    return F.when(F.coalesce(parent["value"], F.lit(False)), changed).otherwise(flags)


def vendor_evidence(records: DataFrame, lookup: DataFrame, key: str = "key") -> DataFrame:
    """Evidence from a vendor's pages. ``lookup``: ``slug, cat_base, storage_temp, …``."""
    hit = records.select(key).join(lookup.select(F.col("slug").alias(key), "cat_base", "storage_temp"), key)
    page = F.concat(F.lit("neb.com/products/"), F.coalesce("cat_base", F.lit("unknown")))
    cold = F.when(F.coalesce("storage_temp", F.lit("")) != "", F.struct(F.lit("requires_ice").alias("flag"), F.concat(page, F.lit(":storage_temp:"), F.replace("storage_temp", F.lit(" "), F.lit(""))).alias("ref"), F.lit(0).alias("ord")))
    sticky = F.struct(F.lit("lo_bind_required").alias("flag"), F.concat(page, F.lit(":enzyme_protein_adsorption")).alias("ref"), F.lit(1).alias("ord"))
    return hit.select(key, F.inline(F.array_compact(F.array(cold, sticky)))).select(key, "flag", F.lit("manufacturer_protocol").alias("type"), "ref", F.lit(True).alias("agrees"), "ord")


def _note(because: Column, cite: Column) -> Column:
    return F.struct(F.lit(None).cast("string").alias("rule_id"), because.alias("because"), cite.alias("cite"), F.lit("medium").alias("confidence"))


def add_note(notes: Column, note: Column, sign: Column, ignore_case: bool = False) -> Column:
    """Append a note unless one with ``sign`` in its reason is there already; a null sign adds nothing."""
    notes = F.coalesce(notes, F.array().cast("array<struct<rule_id:string,because:string,cite:string,confidence:string>>"))
    fold = F.lower if ignore_case else (lambda c: c)
    there = F.exists(notes, lambda n: F.coalesce(F.contains(fold(n["because"]), sign), F.lit(False)))
    return F.when(sign.isNull() | there, notes).otherwise(F.concat(notes, F.array(note)))


def enrich_vendor(records: DataFrame, lookup: DataFrame, key: str = "key") -> DataFrame:
    """Flags, glycerol, storage text and notes from a vendor's pages, for records that ``lookup`` names."""
    rows = lookup.select(F.col("slug").alias(key), *[F.col(c).alias(f"v_{c}") for c in ("cat_base", "storage_temp", "glycerol_pct", "heat_inactivate", "notes")])
    out = enrich(records, vendor_evidence(records, lookup, key), key).join(rows, key, "left")
    cite = F.concat(F.lit("https://www.neb.com/products/"), F.coalesce("v_cat_base", F.lit("unknown")))
    buffer = F.coalesce(F.concat(F.lit(" 50 mM KPO4, "), F.col("v_glycerol_pct").cast("string"), F.lit("% glycerol.")), F.lit(""))
    stored = F.coalesce(blank_to_null(F.col("sds_facts.storage")), F.concat(F.lit("Store at "), blank_to_null(F.col("v_storage_temp")), F.lit("."), buffer), F.col("sds_facts.storage"))
    heat = _note(F.concat(F.lit("Heat inactivatable: "), F.col("v_heat_inactivate"), F.lit(". Heat after the reaction instead of adding a chelator or purifying.")), cite)
    notes = add_note(F.col("bench_knowledge"), heat, F.when(F.coalesce("v_heat_inactivate", F.lit("")) != "", F.lit("heat")), True)
    notes = add_note(notes, _note(F.col("v_notes"), cite), F.substring(blank_to_null(F.col("v_notes")), 1, 30))
    out = out.withColumn("numerics", F.col("numerics").withField("glycerol_pct", F.coalesce(F.col("v_glycerol_pct").cast("double"), F.col("numerics.glycerol_pct"))))
    return out.withColumns({"sds_facts": F.col("sds_facts").withField("storage", stored), "bench_knowledge": notes}).drop(*[c for c in out.columns if c.startswith("v_")])


def protein_evidence(hits: DataFrame, key: str = "key") -> DataFrame:
    """Evidence from a protein database's hits (``key, accession``)."""
    flags = F.array(*[F.struct(F.lit(f).alias("flag"), F.lit(i).alias("ord")) for i, f in enumerate(("is_protein", "lo_bind_required"))])
    return hits.filter("accession IS NOT NULL").select(key, "accession", F.inline(flags)).select(key, "flag", F.lit("uniprot").alias("type"), F.format_string("uniprot:%s", "accession").alias("ref"), F.lit(True).alias("agrees"), "ord")


def apply_overrides(records: DataFrame, overrides: DataFrame, ref: str, cas: str = "cas", strict_keys: bool = False) -> DataFrame:
    """Category, numbers and flags from a curated table (``cas, category, numerics MAP, flags MAP<STRING, BOOLEAN>``). Unlike evidence, it can change known values."""
    side = overrides.select(F.col("cas").alias("__cas"), F.col("category").alias("o_category"), F.col("numerics").alias("o_numerics"), F.col("flags").alias("o_flags"))
    out = records.withColumn("__cas", lookup_key(F.col(cas), strict_keys)).join(side, "__cas", "left")
    names = F.array_distinct(F.concat(F.map_keys("flags"), F.map_keys("o_flags")))

    def changed(name: Column) -> Column:
        old, given = F.coalesce(F.try_element_at("flags", name), placeholder()), F.try_element_at("o_flags", name)
        source = F.struct(F.lit("claude_inference").alias("type"), F.lit(ref).alias("ref"), F.coalesce(given, F.lit(True)).alias("agrees"))
        sources = union_sources(old["sources"], F.array(source))
        new = F.struct(given.alias("value"), F.when(F.size(sources) > F.size(old["sources"]), confidence(sources)).otherwise(old["confidence"]).alias("confidence"), sources.alias("sources"))
        return F.when(F.map_contains_key("o_flags", name), new).otherwise(old)

    flags = F.when(F.col("o_flags").isNull(), F.col("flags")).otherwise(F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), changed(n).alias("value")))))
    numerics = F.col("numerics")
    for name in records.schema["numerics"].dataType.fieldNames() if "numerics" in records.columns else []:
        given = F.try_element_at("o_numerics", F.lit(name))
        numerics = numerics.withField(name, F.coalesce(given.try_cast(records.schema["numerics"].dataType[name].dataType) if records.schema["numerics"].dataType[name].dataType.typeName() != "array" else F.lit(None), F.col(f"numerics.{name}")))
    update = {"category": F.coalesce(blank_to_null(F.col("o_category")), F.col("category")), "flags": flags}
    if "numerics" in records.columns:
        update["numerics"] = numerics
    return out.withColumns(update).drop("__cas", "o_category", "o_numerics", "o_flags")


def migrate(bare: Column) -> Column:
    """``MAP<STRING, BOOLEAN>`` of the first version as sourced flags; those that came later begin unknown."""
    entries = [F.struct(F.lit(f).alias("key"), placeholder(F.try_element_at(bare, F.lit(f)) if f in FIRST_FLAGS else None).cast(SOURCED).alias("value")) for f in FLAGS]
    return F.map_from_entries(F.array(*entries))


LEGACY = "legacy_handauthored_mvp"


def repair(flags: Column, is_first_ten: Column) -> Column:
    """Provenance repairs: legacy references outside the first ten records, verdicts that don't match the value, and an eye-damage code taken for corrosion."""

    def one(name: Column, f: Column) -> Column:
        def mend(s: Column) -> Column:
            legacy = F.coalesce(s["ref"] == LEGACY, F.lit(False))
            unassessed = F.struct(F.lit("claude_inference").alias("type"), F.lit(NOT_ASSESSED).alias("ref"), F.lit(False).alias("agrees"))
            kept = F.struct(s["type"].alias("type"), s["ref"].alias("ref"), F.coalesce(f["value"], F.lit(False)).alias("agrees"))
            return F.when(legacy & ~is_first_ten, unassessed).when(legacy, kept).otherwise(s)

        eye = lambda s: (s["type"] == "ghs_hcode") & (s["ref"] == "H318")
        mended = F.transform(f["sources"], mend)
        has_eye = (name == "is_corrosive") & F.coalesce(F.exists(mended, eye), F.lit(False))
        sources = F.when(has_eye, F.filter(mended, lambda s: ~F.coalesce(eye(s), F.lit(False)))).otherwise(mended)
        affirmed = F.coalesce(F.exists(sources, lambda s: (tier(s["type"]) == "high") & F.coalesce(s["agrees"], F.lit(False))), F.lit(False))
        value = F.when(has_eye & ~affirmed & F.coalesce(f["value"], F.lit(False)), F.lit(None).cast("boolean")).otherwise(f["value"])
        sure = F.when(sources.eqNullSafe(f["sources"]), f["confidence"]).otherwise(confidence(sources))
        return F.struct(value.alias("value"), sure.alias("confidence"), sources.alias("sources"))

    return F.transform_values(flags, one)


# Categories and the flags that they imply.
INVARIANTS = (("fluorophore", "is_fluorophore"), ("reducing_agent", "is_reducing_agent"), ("fixative", "is_fixative"), ("detergent", "is_detergent"), ("enzyme_glycerol", "is_protein"))


def warnings(flags: Column, category: Column) -> Column:
    """Stored confidences that differ from recomputed ones, and categories whose flag isn't true."""
    differ = F.filter(F.map_entries(flags), lambda e: e["value"]["confidence"].isNotNull() & (e["value"]["confidence"] != inherited_confidence(e["value"]["sources"], flags)))
    stored = F.transform(differ, lambda e: F.concat(F.lit("CONF "), e["key"], F.lit(": stored="), e["value"]["confidence"], F.lit(" computed="), inherited_confidence(e["value"]["sources"], flags)))
    broken = [F.when((category == c) & ~F.coalesce(F.try_element_at(flags, F.lit(f))["value"], F.lit(False)), F.lit(f"INVAR category={c} implies {f}")) for c, f in INVARIANTS]
    return F.concat(F.coalesce(F.array_sort(stored), F.array().cast("array<string>")), F.array_compact(F.array(*broken)))


# What a text may be.
ENUMS = {"physical_state": ("liquid", "solution", "powder", "solid"), "confidence": ("high", "medium", "low"), "viscosity_class": ("low", "moderate", "high")}


def errors(record_columns: Sequence[str]) -> Column:
    """Schema errors of a typed record, sorted: required texts, values of enumerations, sources without kind or reference."""
    checks = [F.when(F.coalesce(F.col("name"), F.lit("")) == "", F.lit("name: missing")), F.when(~F.coalesce(F.col("schema_version") == PRESENT, F.lit(False)), F.lit(f"schema_version: not {PRESENT}"))]
    checks.append(F.when(~F.col("physical_state").isin(*ENUMS["physical_state"]), F.lit("physical_state: not allowed")))
    if "numerics" in record_columns:
        checks.append(F.when(~F.col("numerics.viscosity_class").isin(*ENUMS["viscosity_class"]), F.lit("numerics.viscosity_class: not allowed")))
    bad = F.transform(F.filter(F.map_entries("flags"), lambda e: ~F.coalesce(e["value"]["confidence"].isin(*ENUMS["confidence"]), F.lit(False)) | F.exists(e["value"]["sources"], lambda s: s["type"].isNull() | s["ref"].isNull())), lambda e: F.concat(F.lit("flags."), e["key"], F.lit(": malformed")))
    return F.array_sort(F.concat(F.array_compact(F.array(*checks)), F.coalesce(bad, F.array().cast("array<string>"))))


def validate(records: DataFrame) -> DataFrame:
    """All columns, ``errors``, ``warnings`` and ``status``; only records of the present version have warnings."""
    found = F.when(F.col("schema_version") == PRESENT, warnings(F.col("flags"), F.col("category"))).otherwise(F.array().cast("array<string>"))
    out = records.withColumns({"errors": errors(records.columns), "warnings": found})
    return out.withColumn("status", F.when(F.size("errors") > 0, "failed").when(F.size("warnings") > 0, "warned").otherwise("passed"))


def validation_counts(validated: DataFrame) -> DataFrame:
    """A record with warnings has passed."""
    return validated.agg(F.count_if(F.col("status") != "failed").alias("passed"), F.count_if(F.col("status") == "warned").alias("warned"), F.count_if(F.col("status") == "failed").alias("failed"))


def without_vendor_evidence(records: DataFrame, key: str = "key") -> DataFrame:
    """Records that a protein search is for: not named by a registry number, without one, and no vendor evidence yet."""
    from ..functions.text import is_cas

    sources = F.flatten(F.transform(F.map_values("flags"), lambda f: f["sources"]))
    return records.filter(~is_cas(F.col(key), loose=True) & F.coalesce(F.col("cas"), F.lit("")).eqNullSafe("") & ~F.coalesce(F.exists(sources, lambda s: s["type"] == "manufacturer_protocol"), F.lit(False)))


def changed(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys of records that differ in any of the columns, null-safe."""
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in columns]
    ok = same[0]
    for s in same[1:]:
        ok = ok & s
    return before.alias("b").join(after.alias("a"), key).filter(~ok).select(key)
