import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from titrant.operators import rules
from titrant.plans.ingest import handling_profiles, standard_rules, standard_summaries
from titrant.schemas import FLAGS, NUMERICS, RECORD
from titrant.sources.sinks import profile_documents, with_rule_notes

DETERGENT = {"pipetting.dispense_speed": "slow", "pipetting.technique": "wall_touch_off", "pipetting.no_blowout": "true"}


def record(key, flags=None, state=None, **numbers):
    row = {f.name: None for f in RECORD}
    row |= {"key": key, "name": key, "cas": key, "physical_state": state, "flags": {f: {"value": v, "confidence": c, "sources": []} for f, (v, c) in (flags or {}).items()}}
    row["numerics"] = {n: numbers.get(n) for n in (*NUMERICS, "freeze_thaw_max_cycles", "viscosity_class", "plastic_incompatible")}
    return row


def profiles(spark, *records):
    out = handling_profiles(spark.createDataFrame(records, RECORD)).collect()
    return {r.key: ([x.id for x in r.rules_fired], r.profile, {x.id: x.confidence for x in r.rules_fired}, {x.id: x.field_consensus for x in r.rules_fired}) for r in out}


def test_known_profiles(spark):
    """The two profiles that published records fire, and those that collide."""
    got = profiles(
        spark, record("hood", {"fume_hood_required": (True, "high")}), record("foam", {"is_detergent": (True, "high")}), record("none"),
        record("both", {"is_detergent": (True, "low")}, vapor_pressure_kPa_20C=9.0), record("light", {"is_light_sensitive": (True, "high"), "lo_bind_required": (True, "medium")}),
        record("fix", {"is_fixative": (True, "high"), "is_reducing_agent": (True, "high"), "oxidizes_in_solution": (False, None)}),
        record("dry", {"is_hygroscopic": (True, "high")}), record("dry_solid", {"is_hygroscopic": (True, "high")}, "solid"), record("dry_liquid", {"is_hygroscopic": (True, "high")}, "liquid"),
    )
    assert got["hood"][:3] == (["fume_hood_toxic"], {"safety.fume_hood_required": "true"}, {"fume_hood_toxic": "high"})
    assert got["foam"][:2] == (["detergent_no_foam"], DETERGENT) and got["foam"][3] == {"detergent_no_foam": True}
    assert got["none"][:2] == ([], {})
    assert got["both"][0] == ["pre_wet_volatile", "detergent_no_foam"] and got["both"][1]["pipetting.dispense_speed"] == "slow"
    assert got["both"][2] == {"pre_wet_volatile": "high", "detergent_no_foam": "low"}
    assert got["light"][1]["storage.container"] == "lo_bind"
    assert got["fix"][1]["preparation.make_fresh"] == "false"
    assert got["dry"][0] == [] and got["dry_liquid"][0] == [] and got["dry_solid"][0] == ["desiccator_hygroscopic_solid"]


def test_conditions(spark):
    frame = spark.createDataFrame([(None, "x"), (3, "liquid")], "n int, s string")
    check = lambda wanted, c="n": [r.x for r in frame.select(rules.condition(F.col(c), wanted).alias("x")).collect()]
    assert check({"ne": 3}) == [False, False]
    assert check({"near": 3}) == [False, True]  # an unknown operator says nothing
    assert check({}) == [False, True]
    assert check({"gte": 3, "lt": 4}) == [False, True]
    assert check("liquid", "s") == [False, True]
    always = rules.Rule("a", {}, {"x.y": 1})
    assert [len(r.f) for r in frame.select(rules.compile_rules([always], lambda p: F.col(p)).alias("f")).collect()] == [1, 1]


def model(rule_list, record):
    """Rules in plain Python."""
    fired, profile = [], {}
    for r in rule_list:
        ok = True
        for name, wanted in r.when.items():
            value = record.get(name)
            tests = wanted if isinstance(wanted, dict) else {"eq": wanted}
            ok &= value is not None and all({"gt": lambda a, b: a > b, "gte": lambda a, b: a >= b, "lt": lambda a, b: a < b, "lte": lambda a, b: a <= b, "eq": lambda a, b: a == b, "ne": lambda a, b: a != b}[op](value, v) for op, v in tests.items())
        if ok:
            fired.append(r.id)
            for k, v in r.then.items():
                profile[k] = rules.literal(v)
    return fired, profile


def test_against_model(spark):
    rng = random.Random(7)
    rows = []
    for i in range(150):
        flags = {f: (rng.choice([True, True, False, None]), rng.choice(["high", "medium", "low", None])) for f in FLAGS if rng.random() < 0.7}
        rows.append(record(str(i), flags, rng.choice(["liquid", "solid", None]), glycerol_pct=rng.choice([None, 49.0, 50.0]), vapor_pressure_kPa_20C=rng.choice([None, 4.9, 5.0]), freeze_point_C=rng.choice([None, 15.0]), viscosity_class=rng.choice([None, "high"])))
    got = profiles(spark, *rows)
    rank = {"low": 0, "medium": 1, "high": 2}
    for r in rows:
        flat = {f: v["value"] for f, v in r["flags"].items()} | r["numerics"] | {"physical_state": r["physical_state"]}
        assert got[r["key"]][:2] == model(standard_rules(), flat)
        for rule in standard_rules():
            if rule.id in got[r["key"]][2]:
                assert got[r["key"]][2][rule.id] == min(((r["flags"].get(p) or {}).get("confidence") or "high" for p in rule.when), key=rank.get)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from(["a.x", "a.y", "b.z"]), st.sampled_from([True, False, 1, 2.5, "s"]), min_size=1), min_size=1, max_size=5))
def test_last_writer_wins(spark, thens):
    rule_list = [rules.Rule(str(i), {}, then) for i, then in enumerate(thens)]
    got = rules.apply_rules(spark.range(1), rule_list, lambda p: F.col(p)).first().profile
    assert got == model(rule_list, {})[1]


def test_conflicts_and_reports(spark):
    frame = handling_profiles(spark.createDataFrame([record("k", {"is_light_sensitive": (True, "high"), "lo_bind_required": (True, "high")}), record("n")], RECORD))
    row = rules.conflicts(frame, standard_rules(), "key").first()
    assert (row.key, row.path, row["values"], row.rules) == ("k", "storage.container", ["amber_or_foil", "lo_bind"], ["light_protect_sensitive", "lo_bind_adsorption_prone"])
    assert {(r.n_rules, r.n_records) for r in rules.histogram(frame).collect()} == {(2, 1), (0, 1)}
    doc = {r.key: r.value for r in profile_documents(frame).collect()}["k"]
    assert '"handling_profile":{"storage":{' in doc and '"conflicts":[]' in doc
    assert [len(r.bench_knowledge) for r in with_rule_notes(frame).orderBy("key").collect()] == [2, 0]


def test_summaries_cover_rules():
    assert set(standard_summaries()) == {r.id for r in standard_rules()} and len(standard_rules()) == 22


def test_raw_properties(spark):
    frame = spark.sql("""SELECT parse_json('{"a": {"value": null}, "b": {"value": true, "confidence": "low"}, "c": false, "d": null}') AS p""")
    got = frame.select(*[rules.raw_value(F.col("p"), k, "boolean").alias(k) for k in "abcde"]).first()
    assert tuple(got) == (None, True, False, None, None)


@pytest.mark.parametrize("name", ["rules_fired_long", "rules_profile_merge"])
def test_no_shuffle(spark, name):
    from titrant.plans.registry import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
