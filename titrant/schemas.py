"""The types of the data model. Everything is read with these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# The flags of a record, in their order.
FLAGS = (
    "is_protein", "is_volatile", "is_flammable", "is_light_sensitive", "is_fluorophore", "is_reducing_agent", "oxidizes_in_solution", "make_fresh", "is_detergent", "is_foaming", "is_fixative", "fume_hood_required", "is_hygroscopic",
    "is_deliquescent", "is_corrosive", "is_adsorption_prone", "lo_bind_required", "requires_ice", "skin_penetrant", "is_oxidizer", "is_air_sensitive", "is_peroxide_forming", "is_water_reactive", "is_rnase_decontaminant", "is_serum",
)
#: Flags that the first version had already; the others began empty with the second.
FIRST_FLAGS = FLAGS[:19]
NUMERICS = ("glycerol_pct", "viscosity_mPas_20C", "vapor_pressure_kPa_20C", "flash_point_C", "excitation_nm", "emission_nm", "solution_half_life_at_4C_days", "freeze_point_C", "storage_temp_C")

# The tier of each kind of evidence; any other kind is low.
TIERS = {
    "sds_phrase": "high", "storage_class": "high", "ghs_hcode": "high", "pubchem": "high", "chebi": "high", "uniprot": "high", "manufacturer_protocol": "medium", "tacit_knowledge": "low", "claude_inference": "low", "rule_derived": "inherit",
}


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


S, B, D, I = T.StringType(), T.BooleanType(), T.DoubleType(), T.IntegerType()  # noqa: E741
SOURCE = struct(type=S, ref=S, agrees=B)
SOURCED = struct(value=B, confidence=S, sources=T.ArrayType(SOURCE))
FLAG_MAP = T.MapType(S, SOURCED)
NUMERIC_STRUCT = T.StructType([*[T.StructField(n, D) for n in NUMERICS], T.StructField("freeze_thaw_max_cycles", I), T.StructField("viscosity_class", S), T.StructField("plastic_incompatible", T.ArrayType(S))])
GHS = struct(pictograms=T.ArrayType(S), signal_word=S, hazard_statements=T.ArrayType(S))
FACTS = struct(storage=S, ppe=T.ArrayType(S), incompatibilities=T.ArrayType(S))
NOTE = struct(rule_id=S, because=S, cite=S, confidence=S)
RECORD = struct(
    key=S, schema_version=S, name=S, cas=S, cas_note=S, category=S, vendor_example=S, physical_state=S, numerics=NUMERIC_STRUCT, flags=FLAG_MAP, ghs=GHS, sds_facts=FACTS, bench_knowledge=T.ArrayType(NOTE), sds_source=struct(revision_date=S, version=S, product_number=S)
)
FIRED = struct(id=S, because=S, cite=S, confidence=S, field_consensus=B)
PROFILE = struct(reagent_name=S, cas=S, handling_profile=T.MapType(S, T.MapType(S, S)), rules_fired=T.ArrayType(FIRED), conflicts=T.ArrayType(S))
TABLE_ROW = struct(pmcid=S, journal=S, year=S, category=S, reagent_name=S, source=S, identifier=S, additional_info=S, parser_warnings=S)
MANIFEST = struct(pmcid=S, journal=S, year=S, title=S, has_xml=S, fetch_ok=S)
