"""The rules engine: a list of rules becomes one column expression over typed properties.

A rule fires if all its conditions hold; a null property fails any condition. Firing, the merged profile and its
confidence are one projection: records are never joined with rules, nothing is shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.first_match import all_of, first_match, most_important

Lookup = Callable[[str], Column]
OPERATORS: dict[str, Callable[[Column, object], Column]] = {"gt": lambda c, v: c > v, "gte": lambda c, v: c >= v, "lt": lambda c, v: c < v, "lte": lambda c, v: c <= v, "eq": lambda c, v: c == v, "ne": lambda c, v: c != v}
RANKS = {"low": 0, "medium": 1, "high": 2}


@dataclass(frozen=True)
class Rule:
    id: str
    when: dict = field(default_factory=dict)
    then: dict = field(default_factory=dict)
    because: str = ""
    cite: str = ""

    @property
    def field_consensus(self) -> bool:
        return "field consensus" in self.cite.lower()


def from_dicts(rows: Sequence[dict]) -> list[Rule]:
    """Rules as read from YAML or JSON, in order. Values of ``then`` may be nested or dotted."""
    return [Rule(str(r["id"]), dict(r.get("when") or {}), flat(r.get("then") or {}), r.get("because") or "", r.get("cite") or "") for r in rows]


def flat(tree: dict, before: str = "") -> dict[str, object]:
    out: dict[str, object] = {}
    for k, v in tree.items():
        if isinstance(v, dict):
            out |= flat(v, f"{before}{k}.")
        else:
            out[f"{before}{k}"] = v
    return out


def condition(value: Column, wanted: object) -> Column:
    """A literal is compared for equality; a dict is a conjunction of operators, of which unknown ones say nothing."""
    if not isinstance(wanted, dict):
        return F.coalesce(value == F.lit(wanted), F.lit(False))
    tests = [OPERATORS[op](value, F.lit(v)) for op, v in wanted.items() if op in OPERATORS]
    return F.coalesce(value.isNotNull() & all_of(tests), F.lit(False))


def fires(rule: Rule, value: Lookup) -> Column:
    return all_of([condition(value(p), w) for p, w in rule.when.items()])


def rank(confidence: Column) -> Column:
    return first_match([(confidence == k, v) for k, v in RANKS.items()], 0)


def rule_confidence(rule: Rule, confidence: Lookup) -> Column:
    """The least confidence of the properties in the conditions; a property without any counts as high."""
    best = F.lit("high")
    for p in rule.when:
        c = F.coalesce(confidence(p), F.lit("high"))
        best = F.when(rank(c) < rank(best), c).otherwise(best)
    return best


def literal(value: object) -> str:
    """A directive's value as JSON writes it, without quotes around text."""
    return str(value).lower() if isinstance(value, bool) else str(value)


def compile_rules(rules: Sequence[Rule], value: Lookup, confidence: Lookup | None = None) -> Column:
    """``ARRAY<STRUCT<ord, id, because, cite, confidence, field_consensus>>`` of the rules that fire, in their order."""
    confidence = confidence or (lambda _: F.lit(None).cast("string"))
    rows = []
    for i, r in enumerate(rules):
        parts = {"ord": F.lit(i), "id": F.lit(r.id), "because": F.lit(r.because), "cite": F.lit(r.cite), "confidence": rule_confidence(r, confidence), "field_consensus": F.lit(r.field_consensus)}
        rows.append(F.when(fires(r, value), F.struct(*[c.alias(k) for k, c in parts.items()])))
    return F.array_compact(F.array(*rows))


def directives(rules: Sequence[Rule]) -> Column:
    """``MAP<id, MAP<path, value>>``, folded into the plan as a constant."""
    return F.create_map(*[x for r in rules for x in (F.lit(r.id), F.create_map(*[F.lit(y) for k, v in r.then.items() for y in (k, literal(v))]).cast("map<string,string>") if r.then else F.create_map().cast("map<string,string>"))])


def merged_profile(rules: Sequence[Rule], fired: Column) -> Column:
    """``MAP<path, value>``: each rule's directives in order, later ones over earlier ones."""
    table = directives(rules)
    empty = F.create_map().cast("map<string,string>")
    # written without map_concat, so that it doesn't hang on the session's policy for keys that occur twice
    merge = lambda acc, r: F.map_from_entries(F.concat(F.filter(F.map_entries(acc), lambda e: ~F.map_contains_key(table[r["id"]], e["key"])), F.map_entries(table[r["id"]])))
    return F.reduce(fired, empty, merge)


def apply_rules(records: DataFrame, rules: Sequence[Rule], value: Lookup, confidence: Lookup | None = None) -> DataFrame:
    """All columns, and ``rules_fired``, ``profile`` (dotted paths) and ``conflicts`` (none: see :func:`conflicts`)."""
    out = records.withColumn("rules_fired", compile_rules(rules, value, confidence))
    return out.withColumn("profile", merged_profile(rules, F.col("rules_fired"))).withColumn("conflicts", F.array().cast("array<string>"))


def record_lookup(flags: str = "flags", numerics: str = "numerics", flat_columns: Sequence[str] = ("physical_state",), numeric_names: Sequence[str] = ()) -> tuple[Lookup, Lookup]:
    """Value and confidence of a property of typed records: a flat column, a number, else a flag."""

    def value(p: str) -> Column:
        if p in flat_columns:
            return F.col(p)
        return F.col(numerics)[p] if p in numeric_names else F.col(flags)[p]["value"]

    def confidence(p: str) -> Column:
        return F.lit(None).cast("string") if p in flat_columns or p in numeric_names else F.col(flags)[p]["confidence"]

    return value, confidence


def raw_value(properties: Column, name: str, kind: str) -> Column:
    """A property of raw JSON (VARIANT), bare or with a value inside; a null inside stays null."""
    inside = F.try_variant_get(properties, f"$.{name}.value", kind)
    is_object = F.coalesce(F.schema_of_variant(F.try_variant_get(properties, f"$.{name}", "variant")).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, inside).otherwise(F.try_variant_get(properties, f"$.{name}", kind))


def nested_profile(profile: Column) -> Column:
    """Dotted paths as two levels, for the sink."""
    groups = F.array_distinct(F.transform(F.map_keys(profile), lambda k: F.substring_index(k, ".", 1)))
    inside = lambda g: F.transform(F.filter(F.map_entries(profile), lambda e: F.substring_index(e["key"], ".", 1) == g), lambda e: F.struct(F.substring_index(e["key"], ".", -1).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(F.transform(groups, lambda g: F.struct(g.alias("key"), F.map_from_entries(inside(g)).alias("value"))))


def fired_long(applied: DataFrame, *keys: str) -> DataFrame:
    """One row per firing."""
    return applied.select(*keys, F.inline("rules_fired"))


def conflicts(applied: DataFrame, rules: Sequence[Rule], *keys: str) -> DataFrame:
    """Paths that fired rules of one record give different values: ``keys, path, n_values, values, rules``."""
    table = directives(rules)
    rows = applied.select(*keys, F.explode("rules_fired").alias("r")).select(*keys, F.col("r.ord").alias("ord"), F.col("r.id").alias("id"), F.explode(table[F.col("r.id")]).alias("path", "value"))
    grouped = rows.groupBy(*keys, "path").agg(F.array_sort(F.collect_set("value")).alias("values"), F.array_sort(F.collect_list(F.struct("ord", "id"))).alias("by"))
    return grouped.filter(F.size("values") > 1).select(*keys, "path", F.size("values").alias("n_values"), "values", F.col("by.id").alias("rules"))


def frequency(applied: DataFrame) -> DataFrame:
    """How often each rule fired, most often first; ties by the rules' order."""
    return applied.select(F.inline("rules_fired")).groupBy("ord", "id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ord").select("id", "n")


def histogram(applied: DataFrame) -> DataFrame:
    return applied.groupBy(F.size("rules_fired").alias("n_rules")).agg(F.count("*").alias("n_records"))


def with_least_rules(applied: DataFrame, least: int) -> DataFrame:
    return applied.filter(F.size("rules_fired") >= least) if least > 0 else applied


def bench_notes(fired: Column) -> Column:
    """Firings as the notes that are written back to a record."""
    return F.transform(fired, lambda r: F.struct(r["id"].alias("rule_id"), r["because"].alias("because"), r["cite"].alias("cite"), r["confidence"].alias("confidence")))


# Pictograms, the most severe first.
SEVERITY = ("skull_crossbones", "health_hazard", "corrosion", "oxidizer", "exploding_bomb", "flame", "gas_cylinder", "environment", "exclamation_mark")


def top_pictogram(pictograms: Column) -> Column:
    return most_important(pictograms, SEVERITY)


def summary_fact(fired_ids: Column, sentences: dict[str, str]) -> Column:
    """The sentence of the first rule of ``sentences`` that fired."""
    return first_match([(F.array_contains(fired_ids, k), v) for k, v in sentences.items()], "No special handling required")


def manifest(records: DataFrame, profiles: DataFrame, sentences: dict[str, str], key: str = "key") -> DataFrame:
    """The published index: records with their profiles, if any, by category and name."""
    fired = profiles.select(key, F.transform("rules_fired", lambda r: r["id"]).alias("ids"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    out = records.join(fired, key, "left").select(
        "name", "cas", "category", top_pictogram(F.coalesce(F.col("ghs.pictograms"), F.array().cast("array<string>"))).alias("top_pictogram"), F.col("ghs.signal_word").alias("signal_word"),
        summary_fact(ids, sentences).alias("summary_fact"), F.size(ids).alias("rules_fired_count"), F.concat(F.col(key), F.lit(".json")).alias("file"),
    )
    return out.orderBy(F.coalesce(F.nullif("category", F.lit("")), F.lit("zzz")), F.lower("name"))


def all_paths(rules: Sequence[Rule]) -> list[str]:
    return sorted(functools.reduce(set.union, (set(r.then) for r in rules), set()))
