import pytest
from pyspark.sql import functions as F

from titrant.functions import classify, first_match, sheet, text


def one(spark, column, **values):
    names = list(values)
    rows = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {'string' if not isinstance(v, list) else 'array<string>'}" for n, v in values.items())) if names else spark.range(1)
    return rows.select(column.alias("x")).first().x


@pytest.mark.parametrize(("raw", "want"), [("55 °F / 13 °C", 13.0), ("36 - 46 °F / 2 - 8 °C", 5.0), ("-20 °C", -20.0), ("41 - 44 °C", 42.5), ("Not applicable", None), ("-25--15 °C", None), (None, None)])
def test_temperature(spark, raw, want):
    assert one(spark, sheet.temperature(F.col("a")), a=raw) == want


@pytest.mark.parametrize(("raw", "want"), [("57.26 hPa (67.3 °F)", 5.726), ("< 0.1 hPa (25 °C)", 0.01), ("No data available", None), ("3 kPa", 3.0)])
def test_vapor_pressure(spark, raw, want):
    assert one(spark, sheet.vapor_pressure(F.col("a")), a=raw) == want


def test_viscosity(spark):
    assert one(spark, sheet.viscosity(F.col("a")), a="1,412 mPa.s") == 1412.0
    got = spark.createDataFrame([(4.9,), (5.0,), (100.0,), (100.1,), (None,)], "v double").select(sheet.viscosity_class(F.col("v")).alias("c")).collect()
    assert [r.c for r in got] == ["low", "moderate", "moderate", "high", None]


def test_pictograms(spark):
    assert one(spark, sheet.pictograms(F.col("a")), a=["H241 x", "H280 y", "H360FD z", "H241 w"]) == ["compressed_gas", "flame"]
    assert one(spark, sheet.pictograms(F.col("a")), a=[]) == []


@pytest.mark.parametrize(("raw", "want"), [("Fetal  Bovine Serum (Gibco)", "fetal bovine serum"), (" A (1) (2)", "a (1)"), ("x  y", "x y"), ("", "")])
def test_normalize_name(spark, raw, want):
    assert one(spark, text.normalize_name(F.col("a")), a=raw) == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [("opti-mem reduced serum medium", "media"), ("goat serum", "serum"), ("anti-CD3", "antibody"), ("nuclease-free water", "kit"), ("lipase", "enzyme"), ("sodium", "other"), ("Antimycin A", "other"), ("recombinant mouse il-6", "growth_factor"), ("recombinant trypsin", "enzyme"), ("RNA kit", "kit")],
)
def test_reagent_class(spark, raw, want):
    assert one(spark, classify.reagent_class(F.col("a")), a=raw) == want


@pytest.mark.parametrize(
    ("cells", "want"),
    [
        (["Chemicals, Peptides & Recombinant Proteins", "", ""], "Chemicals, Peptides, and Recombinant Proteins"), (["Antibodies", "—", "N/A"], "Antibodies"), (["Antibody A", "real", "data"], None), (["Other"], "Other"), (["", ""], None), ([], None),
        (["Cell Lines", "Cell Lines", " Cell Lines "], "Experimental Models: Cell Lines"),
    ],
)
def test_heading_category(spark, cells, want):
    assert one(spark, classify.heading_category(F.col("a")), a=cells) == want


@pytest.mark.parametrize(("raw", "want"), [("Resource Type", "category"), ("Resource", "reagent"), ("SOURCE", "source"), ("Cat#", "identifier"), ("Note", "additional"), ("x", None), (" ", None)])
def test_header_role(spark, raw, want):
    assert one(spark, classify.header_role(F.col("a")), a=raw) == want


@pytest.mark.parametrize(("raw", "want"), [("opti-mem dulbecco's 3t3", "Opti-Mem Dulbecco'S 3T3"), ("", "")])
def test_title_case(spark, raw, want):
    assert one(spark, text.title_case(F.col("a")), a=raw) == want


def test_cells_and_keys(spark):
    got = [one(spark, text.csv_cell(F.col("a")), a=x) for x in ("N/A", "None", "n/a", "NA", "NULL", None, "none", "Not applicable")]
    assert got == ["", "", "", "", "", "", "none", "Not applicable"]
    assert one(spark, text.lookup_key(F.col("a")), a="") == "N/A"
    assert one(spark, text.lookup_key(F.col("a"), strict_keys=True), a="") is None
    assert [one(spark, text.is_cas(F.col("a")), a=x) for x in ("50-00-0", "50-00", None)] == [True, False, False]
    assert one(spark, text.is_cas(F.col("a"), loose=True), a="50-00")
    assert one(spark, text.slugify(F.col("a")), a=" Tris (pH 8)! ") == "tris-ph-8"
    assert one(spark, text.clean_catalog(F.col("a")), a="Cat# A1") == "A1"
    assert one(spark, text.truthy(F.col("a")), a=" Yes ") and not one(spark, text.truthy(F.col("a")), a=None)


def test_protein_queries(spark):
    got = one(spark, text.protein_queries(F.col("a")), a="Recombinant human TNF-α")
    assert [(r.label, r.query.split(" AND ")[0]) for r in got] == [("gene_human", "gene:TNF-A"), ("name_exact", 'protein_name:"TNF-A"'), ("gene_any", "gene:TNF-A"), ("gene_nohyphen", "gene:TNFA")]
    assert [r.label for r in one(spark, text.protein_queries(F.col("a")), a="alkaline phosphatase from calf intestine")] == ["name_exact", "name_partial"]


def test_first_match(spark):
    assert one(spark, first_match.most_important(F.col("a"), ["x", "y"]), a=["z", "y"]) == "y"
    assert one(spark, first_match.most_important(F.col("a"), ["x"]), a=["q", "z"]) == "q"
    assert one(spark, first_match.most_important(F.col("a"), ["x"]), a=[]) is None


def test_sections(spark):
    got = one(spark, sheet.sections(F.col("a")), a="7. X not a heading\nSECTION 1. Alpha\nbody\nSection 4. no\nSECTION 12. Beta\nSECTION 1. Gamma")
    assert got == {1: "amma", 12: "eta\n"}
    assert one(spark, sheet.sections(F.col("a")), a="") == {}


def test_sheet_details(spark):
    got = one(spark, sheet.protection(F.col("a")), a="Hand protection\nMaterial : Nitrile rubber\nEye protection : Safety glasses\nRespiratory protection : required when dusts form")
    assert got == ["nitrile gloves", "safety glasses", "respiratory protection"]
    assert one(spark, sheet.protection(F.col("a")), a="") == ["gloves", "eye protection"]
    assert one(spark, sheet.incompatibilities(F.col("a")), a="Incompatible materials : acids\nNone known\nHazardous decomp") == []
    frame = spark.createDataFrame([(-20.5, "dry"), (4.0, None), (20.9, None), (None, None)], "t double, c string")
    assert [r.x for r in frame.select(sheet.storage_sentence(F.col("t"), F.col("c")).alias("x")).collect()] == ["Store at -20°C (freezer). dry", "Store at 2–8°C (refrigerator).", "Store at approximately 20°C.", "Store per SDS."]
