"""Registered queries of safety sheets: sheets of suppliers whose lines vary with the supplier's key.

The SQL never sees a sheet's text: it says from the key what each line holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sheet
from .common import Entry, sql_values, table

K = "s_suppkey"
FIRST = ("H302", "H314", "H224", "H290", "H400", "H360FD", "H271")
SECOND = ("H315", "H225", "H318", "H330")
MATERIALS = ("Nitrile rubber", "butyl-rubber", "Neoprene", "natural latex", "Leather")
LOOKS = ("Liquid", "powder", "Viscous", "crystals", "gaseous")


def _pick(items: tuple[str, ...], by: int | None = None, shift: int = 0) -> str:
    return f"CASE ({K} + {shift}) % {by or len(items)} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(items)) + " END"


#: Lines of a sheet as Spark expressions; a null line isn't there.
LINES = (
    f"concat('Revision Date 0', {K} % 9 + 1, '/02/2024 Version ', {K} % 7, '.', {K} % 3)",
    "'SECTION 1. Identification'", f"concat('Product name : Salt ', {K})", f"concat('CAS-No. : ', {K} % 900 + 100, '-', {K} % 90 + 10, '-', {K} % 10)",
    f"CASE WHEN {K} % 5 <> 0 THEN concat('Product Number : S', {K}) END", f"CASE WHEN {K} % 2 = 0 THEN 'Brand : Sigma' END",
    "'SECTION 2. Hazards'", f"CASE {K} % 4 WHEN 0 THEN 'Signal word : Danger' WHEN 1 THEN 'Signal word : Warning' WHEN 2 THEN 'Not a hazardous substance or mixture.' END",
    f"concat({_pick(FIRST)}, ' Harms number ', {K}, '..')", f"concat({_pick(SECOND)}, ' Second harm here')", f"concat({_pick(FIRST)}, ' Said once more.')",
    "'SECTION 7. Handling and storage'", f"CASE {K} % 6 WHEN 0 THEN 'Storage class : 8B Corrosive' WHEN 1 THEN 'Storage class : 5.1 Oxidizing' WHEN 2 THEN 'Storage class : 11 Solid' END",
    f"CASE {K} % 5 WHEN 0 THEN concat('Recommended storage : ', {K} % 6, ' - ', {K} % 6 + 3, ' °C') WHEN 1 THEN concat('Recommended storage : -', {K} % 30 + 1, ' °C') WHEN 2 THEN concat('Recommended storage : 70 °F / ', {K} % 40, ' °C') WHEN 3 THEN 'Recommended storage : Not applicable' END",
    f"CASE WHEN {K} % 3 = 0 THEN 'Very hygroscopic.' END", f"CASE WHEN {K} % 4 = 1 THEN 'Protect from light, and work under hood' END",
    "'SECTION 8. Exposure controls'", f"CASE WHEN {K} % 7 <> 6 THEN concat('Hand protection\\nMaterial : ', {_pick(MATERIALS)}) END", f"concat('Eye protection : ', CASE {K} % 3 WHEN 0 THEN 'Tight goggles' WHEN 1 THEN 'Safety glasses' ELSE 'Face shield' END, '\\nHygiene')",
    f"CASE {K} % 3 WHEN 0 THEN 'Respiratory protection : required when dusts form' WHEN 1 THEN 'Respiratory protection : not required' END",
    "'SECTION 9. Physical'", f"concat('Appearance : ', {_pick(LOOKS)})", f"CASE WHEN {K} % 4 <> 3 THEN concat('Flash point : ', {K} % 90, ' °C') END",
    f"CASE {K} % 4 WHEN 0 THEN concat('Vapor pressure : ', {K} % 50, ' hPa (20 °C)') WHEN 1 THEN concat('Vapor pressure : < ', {K} % 9 + 1, ' hPa') WHEN 2 THEN concat('Vapor pressure : ', {K} % 7, '.5 kPa') ELSE 'Vapor pressure : No data available' END",
    f"CASE WHEN {K} % 3 <> 2 THEN concat('Viscosity, dynamic : ', {K} % 2, ',', lpad({K} % 200, 3, '0'), ' mPa.s') END", f"concat('Melting point/ range : ', {K} % 20, ' - ', {K} % 20 + 3, ' °C')",
    "'SECTION 10. Stability'", f"CASE WHEN {K} % 4 = 0 THEN 'Incompatible materials : no data available' ELSE concat('Incompatible materials : Strong acids\\nOxidizer ', {K} % 3, '\\nStrong acids\\nHazardous decomp') END",
)


def sheets(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(K, "s_name", "s_acctbal")
    return s.withColumns({"key": F.col(K).cast("string"), "text": F.concat_ws("\n", *[F.expr(line) for line in LINES])})


def parsed(spark, sf_dir) -> DataFrame:
    return sheet.parse_sheets(sheets(spark, sf_dir))


def sheet_fields(spark, sf_dir):
    p = parsed(spark, sf_dir)
    joined = lambda c: F.array_join(c, "|").alias(c)
    return p.select("key", "name", "revision_date", "version", "cas", "product_number", "brand", "signal_word", joined("hazard_statements"), "storage_temp_C", "physical_state", "flash_point_C", "vapor_pressure_kPa_20C", "viscosity_mPas_20C", "freeze_point_C", "is_flammable", "is_corrosive", "is_volatile", "viscosity_class", joined("ppe"), joined("incompatibilities"), joined("pictograms"))


_PIC = sql_values([(code, name) for name, codes in sheet.PICTOGRAMS for code in codes if (code, name) != ("H241", "exploding_bomb")], "pic", "code, picture")
_T = "CASE s_suppkey % 5 WHEN 0 THEN round((s_suppkey % 6 + s_suppkey % 6 + 3) / 2.0, 1) WHEN 1 THEN -(s_suppkey % 30 + 1) WHEN 2 THEN s_suppkey % 40 END"
_STATE = f"CASE s_suppkey % {len(LOOKS)} WHEN 0 THEN 'liquid' WHEN 1 THEN 'powder' WHEN 2 THEN 'liquid' WHEN 3 THEN 'solid' END"
#: What a sheet says, from the key alone.
TRUTH = f"""{_PIC}, t AS (SELECT s_suppkey, s_acctbal, CAST(s_suppkey AS VARCHAR) AS key, 'Salt ' || s_suppkey AS name, '0' || (s_suppkey % 9 + 1) || '/02/2024' AS revision_date, (s_suppkey % 7) || '.' || (s_suppkey % 3) AS version,
(s_suppkey % 900 + 100) || '-' || (s_suppkey % 90 + 10) || '-' || (s_suppkey % 10) AS cas, CASE WHEN s_suppkey % 5 <> 0 THEN 'S' || s_suppkey END AS product_number, CASE WHEN s_suppkey % 2 = 0 THEN 'Sigma' END AS brand,
CASE s_suppkey % 4 WHEN 0 THEN 'Danger' WHEN 1 THEN 'Warning' END AS signal_word, s_suppkey % 4 = 2 AS harmless, {_pick(FIRST)} AS a, {_pick(SECOND)} AS b, CAST({_T} AS DOUBLE) AS storage_temp_C, {_STATE} AS physical_state,
CAST(CASE WHEN s_suppkey % 4 <> 3 THEN s_suppkey % 90 END AS DOUBLE) AS flash, CAST(CASE s_suppkey % 4 WHEN 0 THEN round((s_suppkey % 50) / 10.0, 4) WHEN 1 THEN round((s_suppkey % 9 + 1) / 10.0, 4) WHEN 2 THEN s_suppkey % 7 + 0.5 END AS DOUBLE) AS vapor,
CAST(CASE WHEN s_suppkey % 3 <> 2 THEN (s_suppkey % 2) * 1000 + s_suppkey % 200 END AS DOUBLE) AS visc FROM supplier),
f AS (SELECT *, CASE WHEN harmless THEN [] ELSE [substr(a, 1, 4), b] END AS codes, CAST(CASE WHEN physical_state = 'liquid' THEN round((s_suppkey % 20 * 2 + 3) / 2.0, 1) END AS DOUBLE) AS freeze_point_C FROM t)"""
_FLAMMABLE = "CASE WHEN coalesce(flash < 60, FALSE) OR list_has_any(codes, ['H224', 'H225', 'H226', 'H228']) THEN TRUE WHEN len(codes) > 0 OR flash IS NOT NULL THEN FALSE END"
_CORROSIVE = "CASE WHEN list_has_any(codes, ['H290', 'H314']) THEN TRUE WHEN len(codes) > 0 THEN FALSE END"
_THICK = "CASE WHEN visc < 5 THEN 'low' WHEN visc <= 100 THEN 'moderate' WHEN visc > 100 THEN 'high' END"
_GLOVES = "CASE WHEN s_suppkey % 7 = 6 THEN 'gloves' ELSE CASE s_suppkey % 5 WHEN 0 THEN 'nitrile gloves' WHEN 1 THEN 'butyl rubber gloves' WHEN 2 THEN 'neoprene gloves' WHEN 3 THEN 'latex gloves' ELSE 'chemical-resistant gloves' END END"
_PPE = f"concat_ws('|', {_GLOVES}, CASE s_suppkey % 3 WHEN 0 THEN 'safety goggles' WHEN 1 THEN 'safety glasses' ELSE 'eye protection' END, CASE WHEN s_suppkey % 3 = 0 THEN 'respiratory protection' END)"
_AVOID = "CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'Strong acids|Oxidizer ' || (s_suppkey % 3) END"
_FIELDS = f"""WITH {TRUTH} SELECT key, name, revision_date, version, cas, product_number, brand, signal_word, CASE WHEN harmless THEN '' ELSE a || ' Harms number ' || s_suppkey || '|' || b || ' Second harm here' END AS hazard_statements, storage_temp_C, physical_state,
flash AS "flash_point_C", vapor AS "vapor_pressure_kPa_20C", visc AS "viscosity_mPas_20C", freeze_point_C, {_FLAMMABLE} AS is_flammable, {_CORROSIVE} AS is_corrosive, vapor > 0.1 AS is_volatile, {_THICK} AS viscosity_class, {_PPE} AS ppe, {_AVOID} AS incompatibilities,
coalesce((SELECT string_agg(DISTINCT picture, '|' ORDER BY picture) FROM pic WHERE NOT harmless AND code IN (a, b)), '') AS pictograms FROM f"""


def sheet_evidence(spark, sf_dir):
    return sheet.sheet_evidence(parsed(spark, sf_dir)).select("key", "flag", "type", "ref")


_EVIDENCE = f"""WITH {TRUTH}, {sql_values(list(sheet.CODE_FLAGS), 'cf', 'code, flag')}
SELECT key, flag, 'ghs_hcode' AS type, code AS ref FROM f, cf WHERE list_contains(codes, code)
UNION ALL SELECT key, 'is_corrosive', 'storage_class', 'Storage class : 8' FROM f WHERE s_suppkey % 6 = 0
UNION ALL SELECT key, 'is_oxidizer', 'storage_class', 'Storage class : 5.1' FROM f WHERE s_suppkey % 6 = 1
UNION ALL SELECT key, 'is_hygroscopic', 'sds_phrase', 'section_7:''hygroscopic''' FROM f WHERE s_suppkey % 3 = 0
UNION ALL SELECT key, 'is_light_sensitive', 'sds_phrase', 'section_7:''Protect from light''' FROM f WHERE s_suppkey % 4 = 1
UNION ALL SELECT key, 'fume_hood_required', 'sds_phrase', 'section_7:''work under hood''' FROM f WHERE s_suppkey % 4 = 1"""


def sheet_audit(spark, sf_dir):
    return sheet.audit_matrix(parsed(spark, sf_dir)).select("key", "is_hygroscopic", "is_light_sensitive", "is_oxidizer", "is_corrosive_storage_hint", "fume_hood_required")


def audit_tally(spark, sf_dir):
    return sheet.audit_hits(parsed(spark, sf_dir)).groupBy("flag", "hit").agg(F.count("*").alias("n"))


_TALLY = """SELECT flag, hit, count(*) AS n FROM (SELECT 'is_hygroscopic' AS flag, 'S7:hygroscopic' AS hit FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT 'is_light_sensitive', 'S7:Protect from light' FROM supplier WHERE s_suppkey % 4 = 1 UNION ALL SELECT 'is_oxidizer', 'S7:Storage class : 5.1' FROM supplier WHERE s_suppkey % 6 = 1
UNION ALL SELECT 'is_corrosive_storage_hint', 'S7:Storage class : 8' FROM supplier WHERE s_suppkey % 6 = 0 UNION ALL SELECT 'fume_hood_required', 'S7:work under hood' FROM supplier WHERE s_suppkey % 4 = 1) GROUP BY 1, 2"""

#: The record that a supplier may have before its sheet comes, as columns of both engines.
OLD = {
    "name": f"CASE {K} % 3 WHEN 0 THEN '' WHEN 1 THEN concat('Old ', {K}) END", "cas": f"CASE WHEN {K} % 4 = 0 THEN '1-11-1' END", "category": f"CASE {K} % 5 WHEN 0 THEN '' WHEN 1 THEN 'buffer' END",
    "vendor_example": f"CASE WHEN {K} % 6 = 0 THEN 'V 1' END", "physical_state": f"CASE WHEN {K} % 2 = 0 THEN 'solution' END", "storage": f"CASE WHEN {K} % 7 = 0 THEN 'Keep cool.' WHEN {K} % 7 = 1 THEN '' END",
    "flash_point_C": "CAST(99 AS DOUBLE)", "is_volatile": f"{K} % 2 = 0",
}


def merge_precedence(spark, sf_dir):
    """Sheets over the records that two suppliers in three have."""
    s = table(spark, sf_dir, "supplier").filter(f"{K} % 3 <> 2")
    records = s.select(F.col(K).cast("string").alias("key"), *[F.expr(e).alias(c) for c, e in OLD.items()], F.expr(f"CASE WHEN {K} % 2 = 0 THEN array('old gear') ELSE array() END").cast("array<string>").alias("incompatibilities"))
    out = sheet.merge_with_record(parsed(spark, sf_dir), records)
    return out.select("key", "name", "cas", "category", "vendor_example", "physical_state", "storage", "flash_point_C", "is_volatile", F.array_join("incompatibilities", "|").alias("incompatibilities"))


def _old(column: str) -> str:
    return f"CASE WHEN s_suppkey % 3 <> 2 THEN {OLD[column]} END"


_STORED = "trim(CASE WHEN storage_temp_C IS NULL THEN 'Store per SDS. ' WHEN storage_temp_C <= -15 THEN 'Store at ' || CAST(trunc(storage_temp_C) AS INTEGER) || '°C (freezer). ' WHEN storage_temp_C <= 8 THEN 'Store at 2–8°C (refrigerator). ' ELSE 'Store at approximately ' || CAST(trunc(storage_temp_C) AS INTEGER) || '°C. ' END)"
_MERGE = f"""WITH {TRUTH} SELECT key, coalesce(nullif({_old('name')}, ''), name) AS name, cas, nullif({_old('category')}, '') AS category, coalesce({_old('vendor_example')}, trim(concat_ws(' ', brand, product_number))) AS vendor_example,
coalesce(physical_state, {_old('physical_state')}, 'liquid') AS physical_state, coalesce(nullif({_old('storage')}, ''), {_STORED}) AS storage, coalesce(flash, {_old('flash_point_C')}) AS "flash_point_C", coalesce(vapor > 0.1, {_old('is_volatile')}) AS is_volatile,
CASE WHEN s_suppkey % 4 <> 0 THEN {_AVOID} WHEN s_suppkey % 3 <> 2 AND s_suppkey % 2 = 0 THEN 'old gear' ELSE '' END AS incompatibilities FROM f"""

ENTRIES: dict[str, Entry] = {
    "sheet_fields": (sheet_fields, _FIELDS),
    "sheet_evidence": (sheet_evidence, _EVIDENCE),
    "sheet_audit": (sheet_audit, "SELECT CAST(s_suppkey AS VARCHAR) AS key, s_suppkey % 3 = 0 AS is_hygroscopic, s_suppkey % 4 = 1 AS is_light_sensitive, s_suppkey % 6 = 1 AS is_oxidizer, s_suppkey % 6 = 0 AS is_corrosive_storage_hint, s_suppkey % 4 = 1 AS fume_hood_required FROM supplier"),
    "audit_tally": (audit_tally, _TALLY),
    "merge_precedence": (merge_precedence, _MERGE),
}
