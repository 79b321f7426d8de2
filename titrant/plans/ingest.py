"""The ingest chain: sheet to validated record, stage by stage, each a function from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache
from importlib.resources import files

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sheet import merge_with_record, parse_sheets, sheet_evidence
from ..operators import evidence, rules
from ..schemas import NUMERICS


@lru_cache
def standard_rules() -> tuple[rules.Rule, ...]:
    return tuple(rules.from_dicts(yaml.safe_load((files("titrant") / "data" / "rules.yaml").read_text(encoding="utf-8"))))


@lru_cache
def standard_summaries() -> dict[str, str]:
    return yaml.safe_load((files("titrant") / "data" / "summaries.yaml").read_text(encoding="utf-8"))


def handling_profiles(records: DataFrame, rule_list: Sequence[rules.Rule] | None = None) -> DataFrame:
    """Typed records with the rules that fire and the merged profile."""
    value, confidence = rules.record_lookup(numeric_names=(*NUMERICS, "viscosity_class", "freeze_thaw_max_cycles"))
    return rules.apply_rules(records, rule_list or standard_rules(), value, confidence)


def enrich_records(records: DataFrame, sheets: DataFrame | None = None, roles: DataFrame | None = None, overrides: DataFrame | None = None, override_ref: str = "ingest") -> DataFrame:
    """Sheet evidence, role evidence, the fluorophore corollary, then overrides: in this order, as overrides may change known values."""
    out = records
    if sheets is not None:
        out = evidence.enrich(out, sheet_evidence(parse_sheets(sheets)))
    if roles is not None:
        out = evidence.enrich(out, evidence.role_evidence(out, roles))
        out = out.withColumn("flags", evidence.sync_light_sensitive(F.col("flags")))
    if overrides is not None:
        out = evidence.apply_overrides(out, overrides, override_ref)
    return out


def ingest(sheets: DataFrame, records: DataFrame, roles: DataFrame | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """Sheets that have no record yet: parsed, made records of the present version, enriched, ruled and validated."""
    todo = sheets.join(records.select("key"), "key", "left_anti")
    parsed = merge_with_record(parse_sheets(todo), records.select("key", "name", "cas", "category", "vendor_example", "physical_state"))
    bare = F.create_map(*[x for f in ("is_flammable", "is_corrosive", "is_volatile") for x in (F.lit(f), F.col(f))])
    numerics = F.struct(*[(F.col(n) if n in parsed.columns else F.lit(None).cast("double")).alias(n) for n in NUMERICS], F.lit(None).cast("int").alias("freeze_thaw_max_cycles"), F.col("viscosity_class"), F.array().cast("array<string>").alias("plastic_incompatible"))
    made = parsed.select(
        "key", F.lit("2.0").alias("schema_version"), "name", "cas", "category", "vendor_example", "physical_state", numerics.alias("numerics"), evidence.migrate(bare).alias("flags"),
        F.struct("pictograms", "signal_word", "hazard_statements").alias("ghs"), F.struct("storage", "ppe", "incompatibilities").alias("sds_facts"), F.struct("revision_date", "version", "product_number").alias("sds_source"),
    )
    return evidence.validate(handling_profiles(enrich_records(made, todo, roles, overrides)))
