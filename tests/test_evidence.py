import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from titrant.operators import evidence
from titrant.schemas import FLAG_MAP, FLAGS, SOURCE, TIERS, T

SOURCES = T.StructType([T.StructField("s", T.ArrayType(SOURCE))])
some_source = st.tuples(st.sampled_from([*TIERS, "hearsay"]), st.sampled_from(["r1", "r2", "r3"]), st.sampled_from([True, False, None]))


def tier(kind):
    return TIERS.get(kind, "low")


def model(sources):
    yes = lambda a: a is not False
    hy, hn = any(tier(k) == "high" and yes(a) for k, _, a in sources), any(tier(k) == "high" and not yes(a) for k, _, a in sources)
    my = any(tier(k) == "medium" and yes(a) for k, _, a in sources)
    return "high" if hy and not hn else "medium" if my and not hn or hy and hn else "low"


def confidences(spark, lists):
    frame = spark.createDataFrame([(x,) for x in lists], SOURCES)
    return [r.c for r in frame.select(evidence.confidence(F.col("s")).alias("c")).collect()]


def test_literal_confidences(spark):
    high, medium, low = ("chebi", "a", True), ("manufacturer_protocol", "b", True), ("tacit_knowledge", "c", True)
    no = ("ghs_hcode", "d", False)
    lists = [[], [high], [high, no], [medium], [medium, no], [low], [("hearsay", "e", True)], [("rule_derived", "f", True)], None]
    assert confidences(spark, lists) == ["low", "high", "medium", "medium", "low", "low", "low", "low", "low"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(some_source, max_size=5), min_size=1, max_size=12))
def test_confidence_model_and_order(spark, lists):
    assert confidences(spark, lists) == [model(x) for x in lists]
    assert confidences(spark, [x[::-1] for x in lists]) == confidences(spark, lists)
    rows = [(str(i), "f", *s, o) for i, x in enumerate(lists) for o, s in enumerate(x)]
    if rows:
        long = {r.key: r.confidence for r in evidence.confidence_long(spark.createDataFrame(rows, "key string, flag string, type string, ref string, agrees boolean, ord int"), "key").collect()}
        assert long == {str(i): model(x) for i, x in enumerate(lists) if x}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(some_source, max_size=5), st.lists(some_source, max_size=5))
def test_union(spark, old, new):
    frame = spark.createDataFrame([(old, new)], T.StructType([T.StructField("a", T.ArrayType(SOURCE)), T.StructField("b", T.ArrayType(SOURCE))]))
    once = evidence.union_sources(F.col("a"), F.col("b"))
    row = frame.select(once.alias("x"), evidence.union_sources(once, F.col("b")).alias("y")).first()
    want = list({(k, r): (k, r, a) for k, r, a in reversed([*old, *new])}.values())
    assert sorted(map(str, map(tuple, row.x))) == sorted(map(str, want)) and row.x == row.y


def flags_frame(spark, flags, **columns):
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("flags", FLAG_MAP), *[T.StructField(c, T.StringType()) for c in columns]])
    return spark.createDataFrame([("k", {f: {"value": v, "confidence": c, "sources": [dict(zip(("type", "ref", "agrees"), s, strict=True)) for s in ss]} for f, (v, c, ss) in flags.items()}, *columns.values())], schema)


def plain(row, flag):
    f = row.flags[flag]
    return f.value, f.confidence, [tuple(s) for s in f.sources]


NONE = ("claude_inference", "not_yet_assessed", False)


def test_enrich(spark):
    records = flags_frame(spark, {"is_protein": (None, "low", [NONE]), "is_serum": (False, "low", [])})
    rows = [("k", "is_protein", "uniprot", "u", True, 0), ("k", "is_serum", "chebi", "c", True, 1), ("k", "is_oxidizer", "chebi", "x", False, 2), ("k", "is_protein", "uniprot", "u", False, 3), ("z", "is_serum", "chebi", "c", True, 0)]
    new = spark.createDataFrame(rows, "key string, flag string, type string, ref string, agrees boolean, ord int")
    once = evidence.enrich(records, new)
    row = once.first()
    assert plain(row, "is_protein") == (True, "high", [NONE, ("uniprot", "u", True)])
    assert plain(row, "is_serum") == (False, "high", [("chebi", "c", True)])
    assert plain(row, "is_oxidizer") == (None, "low", [NONE, ("chebi", "x", False)])
    assert evidence.enrich(once, new).first().flags == row.flags


def test_role_evidence_and_sync(spark):
    records = spark.createDataFrame([("a", "1-1-1"), ("b", None), ("c", "")], "key string, cas string")
    lookup = spark.createDataFrame([("1-1-1", "C:1", [("dye", "R:2", "is_fluorophore", True), ("x", None, "is_corrosive", None), ("y", None, None, True)]), ("N/A", None, [("ab", None, "is_protein", True)])], "cas string, chebi_id string, roles array<struct<term:string,role_chebi:string,flag:string,agrees:boolean>>")
    got = {(r.key, r.flag, r.ref, r.agrees) for r in evidence.role_evidence(records, lookup).collect()}
    assert got == {("a", "is_fluorophore", "R:2", True), ("a", "is_corrosive", "C:1:x", True), ("b", "is_protein", "ab", True), ("c", "is_protein", "ab", True)}
    assert {r.key for r in evidence.role_evidence(records, lookup, strict_keys=True).collect()} == {"a"}
    frame = flags_frame(spark, {"is_fluorophore": (True, "high", [("chebi", "R", True)])})
    synced = frame.withColumn("flags", evidence.sync_light_sensitive(F.col("flags")))
    assert plain(synced.first(), "is_light_sensitive") == (True, "high", [NONE, ("rule_derived", evidence.DERIVED_LIGHT, True)])
    assert synced.withColumn("flags", evidence.sync_light_sensitive(F.col("flags"))).first().flags == synced.first().flags
    off = flags_frame(spark, {"is_fluorophore": (False, "high", [])})
    assert "is_light_sensitive" not in off.withColumn("flags", evidence.sync_light_sensitive(F.col("flags"))).first().flags


def test_inherited(spark):
    child = [("rule_derived", evidence.DERIVED_LIGHT, True)]
    for parent, extra, want in (("high", [], "high"), (None, [], "low"), ("high", [("manufacturer_protocol", "m", False)], "low"), ("high", [("tacit_knowledge", "t", True)], "high")):
        frame = flags_frame(spark, {"is_fluorophore": (True, parent, []), "is_light_sensitive": (True, "x", child + extra)})
        assert frame.select(evidence.inherited_confidence(F.col("flags")["is_light_sensitive"]["sources"], F.col("flags")).alias("c")).first().c == want


def test_migrate_and_repair(spark):
    bare = spark.sql("SELECT map('is_protein', true, 'is_serum', true) AS b").select(evidence.migrate(F.col("b")).alias("flags")).first()
    assert set(bare.flags) == set(FLAGS) and plain(bare, "is_protein") == (True, "low", [NONE]) and plain(bare, "is_serum") == (None, "low", [NONE])
    flags = {"a": (True, "low", [("tacit_knowledge", evidence.LEGACY, False)]), "is_corrosive": (True, "high", [("ghs_hcode", "H318", True), ("tacit_knowledge", "t", True)]), "ok": (True, "medium", [("chebi", "c", True)])}
    for first_ten, want in ((True, [("tacit_knowledge", evidence.LEGACY, True)]), (False, [NONE])):
        row = flags_frame(spark, flags).withColumn("flags", evidence.repair(F.col("flags"), F.lit(first_ten))).first()
        assert plain(row, "a") == (True, "low", want)
        assert plain(row, "is_corrosive") == (None, "low", [("tacit_knowledge", "t", True)])
        assert plain(row, "ok") == (True, "medium", [("chebi", "c", True)])  # unchanged sources keep their confidence


def test_overrides(spark):
    records = flags_frame(spark, {"is_protein": (True, "high", [("chebi", "c", True)])}, cas="", category="old")
    table = spark.createDataFrame([("N/A", "new", {}, {"is_protein": False, "is_serum": True})], "cas string, category string, numerics map<string,string>, flags map<string,boolean>")
    row = evidence.apply_overrides(records, table, "r").first()
    assert row.category == "new" and plain(row, "is_protein") == (False, "high", [("chebi", "c", True), ("claude_inference", "r", False)]) and plain(row, "is_serum")[0] is True
    assert evidence.apply_overrides(records, table, "r", strict_keys=True).first().category == "old"


def test_vendor(spark):
    schema = "key string, flags map<string,struct<value:boolean,confidence:string,sources:array<struct<type:string,ref:string,agrees:boolean>>>>, numerics struct<glycerol_pct:double>, sds_facts struct<storage:string>, bench_knowledge array<struct<rule_id:string,because:string,cite:string,confidence:string>>"
    records = spark.createDataFrame([("taq", {}, (None,), ("",), []), ("other", {}, (1.0,), ("kept",), None)], schema)
    lookup = spark.createDataFrame([("taq", "m0273", "-20 C", 50.0, "75 C, 20 min", "Do not vortex this enzyme at any time")], "slug string, cat_base string, storage_temp string, glycerol_pct double, heat_inactivate string, notes string")
    once = evidence.enrich_vendor(records, lookup)
    rows = {r.key: r for r in once.collect()}
    assert rows["taq"].flags["requires_ice"].value and rows["taq"].flags["requires_ice"].confidence == "medium" and rows["taq"].numerics.glycerol_pct == 50.0
    assert rows["taq"].sds_facts.storage.startswith("Store at -20 C.") and len(rows["taq"].bench_knowledge) == 2 and rows["other"].sds_facts.storage == "kept"
    assert len({r.key: r for r in evidence.enrich_vendor(once, lookup).collect()}["taq"].bench_knowledge) == 2


def test_validate(spark):
    for category, value, stored, n in itertools.product(["detergent", "x"], [True, None], ["low", "high"], [0]):
        frame = flags_frame(spark, {"is_detergent": (value, stored, [])}, name="n", schema_version="2.0", physical_state="liquid", category=category)
        row = evidence.validate(frame).first()
        assert len(row.warnings) == (stored == "high") + (category == "detergent" and value is None) and row.errors == []
    bad = evidence.validate(flags_frame(spark, {}, name="", schema_version="1.0", physical_state="gas", category="x")).first()
    assert bad.status == "failed" and len(bad.errors) == 3
