"""Incremental work: evidence in any split ends where one batch run does; keys behind a watermark come once."""

import random

import pytest
from pyspark.sql import functions as F

from titrant.operators import evidence
from titrant.streaming import fusion, incremental

ROWS = "key string, flag string, type string, ref string, agrees boolean, ord long"


@pytest.fixture
def stateful(spark):
    old = {k: spark.conf.get(k, None) for k in fusion.PROVIDER}
    for k, v in fusion.PROVIDER.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run(spark, folder, *increments):
    """The changes after each increment, as sets of tuples."""
    out = []
    for rows in increments:
        if rows is not None:
            spark.createDataFrame(rows, ROWS).coalesce(2).write.mode("append").parquet(f"{folder}/in")
        changes = incremental.ingest(spark, f"{folder}/in", spark.createDataFrame([], ROWS).schema, f"{folder}/out", f"{folder}/state", fusion.confidence_changes)
        out.append({tuple(r) for r in changes.collect()})
    return out, {tuple(r) for r in fusion.current(changes).collect()}


def taken(spark, folder, *increments, whole=2):
    """As ``run``, by increments taken whole, with all sources written anew every second time."""
    out = []
    for rows in increments:
        if rows is not None:
            spark.createDataFrame(rows, ROWS).coalesce(2).write.mode("append").parquet(f"{folder}/in")
        changes = incremental.ingest(spark, f"{folder}/in", spark.createDataFrame([], ROWS).schema, f"{folder}/out", f"{folder}/state", fusion.Increments(whole))
        out.append({tuple(r) for r in changes.collect()})
    return out, {tuple(r) for r in fusion.current(changes).collect()}


def batch(spark, rows):
    """By the batch operators, with what the stream says of nulls and ties."""
    df = spark.createDataFrame(rows, ROWS).withColumns({"agrees": F.coalesce("agrees", F.lit(True)), "ord": F.coalesce("ord", F.lit(2**63 - 1)), "no": ~F.coalesce("agrees", F.lit(True))})
    return {tuple(r) for r in evidence.confidence_long(evidence.union_long(df, order=["ord", "no"]), "key", "flag").collect()}


def test_each_change_is_said_once(stateful, tmp_path):
    steps, now = run(
        stateful, str(tmp_path),
        [("k", "f", "tacit_knowledge", "a", True, 1), ("k", "f", "tacit_knowledge", "a", True, 1)],
        [("k", "f", "manufacturer_protocol", "b", None, 2)],
        [("k", "f", "sds_phrase", "c", True, 3), ("k", "g", "rule_derived", "f→g", True, None)],
        [("k", "f", "uniprot", "d", True, 4)],  # high already
        None,  # nothing new
        [("k", "f", "uniprot", "d", False, 2)],  # the earlier row of a source comes late, and counts
    )
    first = {("k", "f", "low", 1, 1)}
    second = first | {("k", "f", "medium", 2, 2)}
    third = second | {("k", "f", "high", 3, 3), ("k", "g", "low", 1, 1)}
    assert steps == [first, second, third, third, third, third | {("k", "f", "medium", 4, 4)}]
    assert now == {("k", "f", "medium"), ("k", "g", "low")}


def test_any_split_equals_one_batch(stateful, tmp_path):
    """Ties, repeats, contradictions and nulls in every column, one hot flag; two and four increments in any order."""
    rng = random.Random(5)
    kinds = ["sds_phrase", "chebi", "manufacturer_protocol", "tacit_knowledge", "rule_derived", "hearsay", None]
    rows = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "c"]), rng.choice(["f", "g", "h", None]), rng.choice(kinds), rng.choice(["r", "s", "", None]), rng.choice([True, False, None]), rng.choice([None, *range(6)])) for _ in range(400)]
    # few sources a flag, so that all three verdicts occur
    rows += [(f"k{i}", "f", rng.choice(kinds), rng.choice(["r", "s"]), rng.choice([True, False, None]), rng.choice([None, *range(6)])) for i in range(40) for _ in range(3)]
    want = batch(stateful, rows)
    assert {c for *_, c in want} == {"low", "medium", "high"}
    rng.shuffle(rows)
    for n, parts in enumerate((2, 4)):
        assert run(stateful, str(tmp_path / str(n)), *[rows[i::parts] for i in range(parts)])[1] == want


def test_whole_increments_say_the_same_changes(spark, tmp_path):
    """Changes and their numbers, nulls and ties, over more increments than sources are written anew; a repeated increment replaces what it left."""
    steps = [[("k", "f", "tacit_knowledge", "a", True, 1)], [("k", "f", "manufacturer_protocol", "b", None, 2), (None, "f", None, None, None, None)], [("k", "f", "sds_phrase", "c", True, 3)], [("k", "f", "uniprot", "d", True, 4)], None, [("k", "f", "uniprot", "d", False, 2)], [(None, "f", "sds_phrase", None, True, 9)]]
    first = {("k", "f", "low", 1, 1)}
    second = first | {("k", "f", "medium", 2, 2), (None, "f", "low", 1, 1)}
    third = second | {("k", "f", "high", 3, 3)}
    last = third | {("k", "f", "medium", 4, 4)}
    said, now = taken(spark, str(tmp_path), *steps)
    assert said == [first, second, third, third, third, last, last | {(None, "f", "high", 2, 2)}]
    assert now == {("k", "f", "medium"), (None, "f", "high")}
    again = spark.createDataFrame(steps[-1], ROWS)
    fusion.Increments(2)(spark, again, 5, f"{tmp_path}/out", f"{tmp_path}/state-kept")
    assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").drop("increment").collect()} == said[-1]


def test_whole_increments_in_any_split(spark, tmp_path):
    rng = random.Random(6)
    kinds = ["sds_phrase", "chebi", "manufacturer_protocol", "tacit_knowledge", "rule_derived", "hearsay", None]
    rows = [("hot" if rng.random() < 0.3 else rng.choice(["a", None]), "f", rng.choice(kinds), rng.choice(["r", "s", "", None]), rng.choice([True, False, None]), rng.choice([None, *range(6)])) for _ in range(100)]
    rows += [(f"k{i}", rng.choice(["f", None]), rng.choice(kinds), rng.choice(["r", "s"]), rng.choice([True, False, None]), rng.choice([None, *range(6)])) for i in range(40) for _ in range(3)]
    rng.shuffle(rows)
    for n, parts in enumerate((1, 5)):
        assert taken(spark, str(tmp_path / str(n)), *[rows[i::parts] for i in range(parts)])[1] == batch(spark, rows)


def test_first_seen_keys_of_a_stream(spark, tmp_path):
    """Repeats within an increment and over increments are one row; times without a zone are taken; null keys are keys."""
    schema = "who string, what string, ts timestamp_ntz"
    work = lambda df: incremental.first_seen(df, ["who", "what"], late="30 days").select("who", "what")
    for day, rows in enumerate(([("a", "x"), ("a", "x"), (None, "x")], [("a", "x"), ("b", "x"), (None, "x")], [])):
        made = spark.createDataFrame(rows, "who string, what string").withColumn("ts", F.lit(f"2024-01-0{day + 1} 10:00:00").cast("timestamp_ntz"))
        made.write.mode("append").parquet(str(tmp_path / "in"))
        seen = incremental.ingest(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, str(tmp_path / "out"), str(tmp_path / "state"), work)
    assert sorted(map(tuple, seen.collect()), key=str) == sorted([("a", "x"), ("b", "x"), (None, "x")], key=str)
    assert incremental.first_seen(spark.createDataFrame([("a", 1), ("a", 2)], "who string, ts int"), ["who"]).count() == 1
