import random

import pytest
from pyspark.sql import functions as F

from titrant.operators import rule_index, rules
from titrant.plans.rule_queries import many_rules, rules_by_the_thousand

FIELDS = "id int, flag boolean, size double, count int, kind string, flag_conf string, size_conf string"
CONFIDENCE = {"flag": "flag_conf", "size": "size_conf"}


def told(p):
    return F.col(CONFIDENCE[p]) if p in CONFIDENCE else F.lit(None).cast("string")


def some_rules(rng, n):
    tests = {
        "flag": [True, False, None, {"ne": True}, {"eq": False}, {}, {"gt": False}],
        "size": [1.5, {"gt": 1}, {"gte": 1.5, "lt": 4}, {"lte": 2.5}, {"ne": 1.5}, {"gt": None}, {"near": 3}, {"gte": 2, "near": 1}, {"lt": -1.0}],
        "count": [2, {"gt": 1}, {"ne": 2, "lte": 3}, {"eq": 7}],
        "kind": ["a", {"ne": "b"}, {"gt": "a"}, {"lte": "é"}, {"eq": "zz"}],
    }
    out = []
    for i in range(n):
        names = rng.sample(list(tests), rng.randrange(0, 4))
        then = {f"{rng.choice('xy')}.{rng.choice('abc')}": rng.choice([True, 2, 2.5, "s"]) for _ in range(rng.randrange(3))}
        out.append(rules.Rule(f"r{i}", {p: rng.choice(tests[p]) for p in names}, then, f"because {i}", rng.choice(["field consensus", "a book"])))
    return out


def some_records(spark, rng, n):
    sure = lambda: rng.choice(["high", "medium", "low", "odd", None])
    rows = [(i, rng.choice([True, False, None]), rng.choice([None, -1.0, 1.0, 1.5, 2.5, 4.0, float("inf"), float("nan")]), rng.choice([None, 1, 2, 3]), rng.choice([None, "", "a", "b", "é", "zz"]), sure(), sure()) for i in range(n)]
    return spark.createDataFrame(rows, FIELDS)


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_expressions(spark, monkeypatch, seed):
    """The same firings, confidences and profiles as from one expression a rule, in slices of any size; extra columns go through."""
    rng = random.Random(seed)
    rule_list, records = some_rules(rng, 40), some_records(spark, rng, 120)
    monkeypatch.setattr(rule_index, "CELLS", rng.choice([1, 300, 1 << 22]))
    want = rules.apply_rules(records, rule_list, F.col, told)
    got = rule_index.apply_indexed(records, rule_list, F.col, told)
    assert got.columns == want.columns and [f.dataType for f in got.schema.fields[:7]] == [f.dataType for f in want.schema.fields[:7]]
    show = lambda df: {r.id: (repr(r.size), [tuple(x) for x in r.rules_fired], list(r.profile.items()), r.conflicts) for r in df.collect()}
    assert show(got) == show(want)


def test_no_rules_no_records_and_wrong_literals(spark):
    records = some_records(spark, random.Random(1), 3)
    assert [(r.rules_fired, r.profile) for r in rule_index.apply_indexed(records, [], F.col).collect()] == [([], {})] * 3
    assert rule_index.apply_indexed(records.limit(0), [rules.Rule("a", {"flag": True})], F.col).count() == 0
    for name, wanted in (("flag", "yes"), ("size", "1"), ("kind", 1), ("size", True)):
        with pytest.raises(TypeError, match="rule wrong"):
            rule_index.apply_indexed(records, [rules.Rule("wrong", {name: wanted})], F.col)


def test_reports_take_indexed_records(spark):
    rng = random.Random(9)
    rule_list, records = some_rules(rng, 30), some_records(spark, rng, 60).withColumnRenamed("id", "key")
    a, b = rules.apply_rules(records, rule_list, F.col, told), rule_index.apply_indexed(records, rule_list, F.col, told)
    for report in (rules.histogram, rules.frequency, lambda x: rules.conflicts(x, rule_list, "key")):
        assert sorted(map(str, report(a).collect())) == sorted(map(str, report(b).collect()))


def test_thousands_of_rules_are_one_pass(spark):
    plan = rules_by_the_thousand(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan and len(plan) < 20_000
    assert len(many_rules()) == 5000


def test_a_shared_test_is_evaluated_once():
    index = rule_index.RuleIndex([rules.Rule(str(i), {"kind": "a", "size": {"gt": i % 3}}) for i in range(1000)], {"kind": "string", "size": "double"})
    assert len(index.postings["kind", "eq"].literals) == 1 and len(index.postings["size", "gt"].literals) == 3


@pytest.mark.parametrize("name", ["rules_by_the_thousand", "typed_rules", "migrate_flags", "protein_names", "rules_fired_long"])
def test_rows_that_are_much_work_are_spread(spark, tmp_path, name):
    """One small file is one split; its rows go to as many tasks as their number asks for, whatever is done with each."""
    from titrant.plans.registry import QUERIES

    spark.range(12_000).selectExpr("id AS p_partkey", "concat('n m', id % 64) AS p_name", "'Brand#1' AS p_brand", "'ECONOMY' AS p_type", "CAST(id % 50 AS INT) AS p_size", "900.0D AS p_retailprice").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    frame = QUERIES[name](spark, str(tmp_path))
    assert frame.rdd.getNumPartitions() >= 3
    keys = frame.select("p_partkey").distinct().count()
    assert keys == 12_000 or name in ("typed_rules", "rules_fired_long") and keys  # not every part fires a rule


def test_many_counters_and_few_give_the_same(spark):
    """Values that share their counters, values that have few, null ones, and confidences that nobody knows: as expressions fire them."""
    made = [rules.Rule(str(i), {"size": {"gte": i % 7, "lt": i % 7 + 3}, **({"kind": {"ne": "ab"[i % 2]}} if i % 3 else {"kind": "c"})}, {f"g.p{i % 4}": i, f"h.p{i % 3}": i}) for i in range(60)]
    rows = [(i, i % 11 if i % 5 else None, "abcd"[i % 4] if i % 6 else None, ("low", "medium", "high", None, "odd")[i % 5]) for i in range(300)]
    frame = spark.createDataFrame(rows, "id long, size int, kind string, sure string")
    by = [apply(frame, made, lambda p: F.col(p), lambda p: F.col("sure") if p == "kind" else F.lit(None)).select("id", F.to_json("rules_fired"), F.to_json("profile")) for apply in (rules.apply_rules, rule_index.apply_indexed)]
    one, other = ({tuple(r) for r in d.collect()} for d in by)
    assert one == other and len(one) == 300
