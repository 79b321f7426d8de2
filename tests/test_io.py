import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titrant.operators import lookups
from titrant.plans.ingest import ingest
from titrant.schemas import RECORD
from titrant.sources import buckets, documents, readers, search, sinks
from titrant.streaming import incremental

SHEET = """Revision Date 01/02/2024 Version 6.1
SECTION 1. Identification
Product name : Example salt
CAS-No. : 7647-14-5
Product Number : S123
Brand : Sigma
SECTION 2. Hazards
Signal word : Danger
H302 Harmful if swallowed.
H314 Causes severe burns.
H302 Harmful again here.
H360FD May damage fertility.
SECTION 7. Handling and storage
Storage class : 8B Corrosive
Recommended storage : 36 - 46 °F / 2 - 8 °C
hygroscopic and protect from light
SECTION 9. Physical
Appearance : Liquid
Flash point : 55 °F / 13 °C
Vapor pressure : 57.26 hPa (67.3 °F)
Viscosity, dynamic : 1,412 mPa.s
Melting point/ range : 41 - 44 °C
SECTION 10. Stability
Incompatible materials : Strong acids
Oxidizers
Strong acids
Hazardous decomp"""


def test_documents_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for key, cas in (("50-00-0", "50-00-0"), ("odd", "1-1-1")):
        (tmp_path / "in" / f"{key}.json").write_text(json.dumps({"name": key, "cas": cas, "flags": {"is_serum": {"value": None, "confidence": "low", "sources": []}}}, indent=2))
    got = readers.json_documents(spark, str(tmp_path / "in"), RECORD)
    assert {(r.key, r.cas) for r in got.collect()} == {("50-00-0", "50-00-0"), ("odd", "1-1-1")}
    assert {r.key for r in readers.raw_documents(spark, str(tmp_path / "in")).collect()} == {"50-00-0", "odd"}
    sinks.records(got, str(tmp_path / "out"))
    back = spark.read.schema(RECORD).json(str(tmp_path / "out"))
    assert {(r.key, r.name) for r in back.collect()} == {("50-00-0", "50-00-0"), ("odd", "odd")}


def test_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\nN/A,"x, ""y"""\nnone,\n')
    rows = readers.csv_text(spark, str(tmp_path / "t.csv"), ["a", "b"])
    assert [tuple(r) for r in rows.collect()] == [("", 'x, "y"'), ("none", "")]
    assert readers.csv_text(spark, str(tmp_path / "t.csv"), ["a", "b"], missing_as_blank=False).first().a == "N/A"
    assert readers.manifest(spark, str(tmp_path / "absent.csv")).count() == 0
    sinks.csv(rows, str(tmp_path / "o"))
    assert readers.csv_text(spark, str(tmp_path / "o"), ["a", "b"]).collect() == rows.collect()


def test_yaml(spark, tmp_path):
    (tmp_path / "l.yaml").write_text("- {k: a, n: 1}\n- {k: b}\n- {k: a, n: 2}\n")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    assert {tuple(r) for r in readers.yaml_table(spark, str(tmp_path / "l.yaml"), schema, "k").collect()} == {("a", 2), ("b", None)}


def test_cache_keeps_misses(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "key string, cas string")
    sinks.cache(make([("a", "1"), ("b", None)]), make([("a", None), ("c", "3")]), str(tmp_path / "c"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "c")).collect()} == {("a", None), ("b", None), ("c", "3")}


def test_search_pages_and_retries():
    pages = {"*": {"resultList": {"result": [{"id": 1}, {"id": 2}]}, "nextCursorMark": "c2"}, "c2": {"resultList": {"result": [{"id": 3}]}, "nextCursorMark": "c2"}}
    calls, waits = [], []

    def get(what):
        calls.append(what)
        return (503, "") if len(calls) == 1 else (200, json.dumps(pages[json.loads(what)["cursorMark"]]))

    assert [h["id"] for h in search.search(get, "q", wait=waits.append)] == [1, 2, 3] and waits == [2.0]
    assert [h["id"] for h in search.search(get, "q", limit=2)] == [1, 2]


@pytest.mark.parametrize(("answer", "waited"), [((503, ""), [2.0, 4.0]), ((200, "<html>"), [2.0, 4.0]), ((404, "gone"), [])])
def test_search_never_ends_early_without_a_word(answer, waited):
    waits = []
    with pytest.raises(search.ServiceError):
        list(search.search(lambda _: answer, "q", wait=waits.append))
    assert waits == waited


def test_search_fails_on_a_later_page():
    first = (200, json.dumps({"resultList": {"result": [{"id": 1}]}, "nextCursorMark": "c2"}))
    with pytest.raises(search.ServiceError):
        list(search.search(lambda what: first if json.loads(what)["cursorMark"] == "*" else (500, ""), "q", wait=lambda _: None))


def test_article_attempts():
    from titrant.sources import fetch, offline

    whole = offline.article("PMC1")[1]
    for answers, want, waited in (([(503, b""), (200, whole)], whole, [2.0]), ([(200, b"<html/>")] * 3, None, [2.0, 4.0]), ([(404, b"")], None, []), ([(403, b"")], None, [])):
        left, waits = list(answers), []
        assert fetch.article(lambda _: left.pop(0), "x", wait=waits.append) == want and waits == waited and not left  # noqa: B023


@pytest.mark.parametrize("n", [0, 1, 5, 300])
def test_index_is_one_json_array_in_order(spark, tmp_path, n):
    rows = spark.range(n).select(F.format_string('n "%04d"', "id").alias("name"), F.lit(None).cast("string").alias("cas")).orderBy(F.desc("name"))
    sinks.index(rows, str(tmp_path / "i"))
    files = sorted((tmp_path / "i").glob("part-*"))
    got = json.loads("".join(f.read_text() for f in files))
    assert [x["name"] for x in got] == [f'n "{i:04d}"' for i in reversed(range(n))] and all("cas" in x for x in got)


def test_profiles_and_mirrors(spark, tmp_path):
    from titrant.plans.rule_queries import applied

    rows = applied(spark, "/root/testdata/sf0.001").limit(20).withColumns({"key": F.col("p_partkey").cast("string"), "name": F.col("p_name"), "cas": F.lit(None).cast("string")}).cache()
    sinks.profiles(rows, str(tmp_path / "rows"))
    assert spark.read.json(str(tmp_path / "rows")).count() == 20
    sinks.profile_files(rows, str(tmp_path / "files"))
    assert {p.stem for p in (tmp_path / "files").glob("*/*.json")} == {r.key for r in rows.collect()}
    small = rows.select("key", "name")
    sinks.mirrors(small.limit(3), str(tmp_path / "b"))
    sinks.mirrors(small, str(tmp_path / "a"), str(tmp_path / "b"))
    assert spark.read.json(str(tmp_path / "a")).count() == spark.read.json(str(tmp_path / "b")).count() == 20


def test_documents_are_read_in_batches(spark, tmp_path, monkeypatch):
    """A folder's documents come as Arrow batches that end behind so many rows or bytes; what isn't UTF-8 fails."""
    path = str(tmp_path / "d")
    documents.write_documents(spark.range(25).selectExpr("CAST(id AS STRING) AS key", "IF(id = 7, repeat('é', 600), concat('v', id)) AS value"), path)
    monkeypatch.setattr(documents, "BATCH", 10)
    monkeypatch.setattr(documents, "BATCH_BYTES", 1000)
    reader = documents.DocumentReader(path, None)
    [folder] = reader.partitions()
    batches = list(reader.read(folder))
    assert max(b.num_rows for b in batches) <= 10 and len(batches) in (3, 4)
    assert {k: v for b in batches for k, v in zip(b["key"].to_pylist(), b["value"].to_pylist(), strict=True)} == {str(i): "é" * 600 if i == 7 else f"v{i}" for i in range(25)}
    assert [b["key"].to_pylist() for b in documents.DocumentReader(path, ["3", "missing"]).read(folder)] == [["3"]] and not list(documents.DocumentReader(path, []).read(folder))
    next(Path(path).glob("*/3.json")).write_bytes(b"\xff")
    with pytest.raises(ValueError):
        list(reader.read(folder))


def test_a_document_for_each_key(spark, tmp_path, monkeypatch):
    """Any keys, in tasks of bounded size; read whole or by key, one index a folder."""
    monkeypatch.setattr(documents, "PER_TASK", 1000)
    keys = ["", ".", "..", "_keys", "a/b", "ä b", "x" * 400, "x" * 399 + "y", "Key", "key%2F", 'q"\n']
    frame = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), F.concat(F.lit("v "), "id").alias("value")).unionByName(spark.createDataFrame([(k, f"of {k}") for k in keys] + [("none", None)], "key string, value string"))
    path = str(tmp_path / "d")
    documents.write_documents(frame, path)
    folders = list(Path(path).iterdir())
    assert len(folders) == 6 and all(len(list(f.iterdir())) < 1300 for f in folders) and [p.name for p in tmp_path.iterdir()] == ["d"]
    got = {r.key: r.value for r in documents.read_documents(spark, path).collect()}
    assert got == {r.key: r.value or "" for r in frame.collect()}
    assert sorted(r.key for r in documents.read_documents(spark, path, ["k7", "a/b", "missing"]).collect()) == ["a/b", "k7"]
    documents.write_documents(frame.limit(3), path)
    assert documents.read_documents(spark, path).count() == 3
    documents.write_documents(frame.limit(0), path)
    assert documents.read_documents(spark, path).count() == 0


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    """The old snapshot stays, and no folder beside it."""
    path = str(tmp_path / "d")
    documents.write_documents(spark.createDataFrame([("old", "1")], "key string, value string"), path)
    rows = spark.range(200).select(F.col("id").cast("string").alias("key"), F.when(F.col("id") == 150, F.raise_error(F.lit("broken"))).otherwise("v").alias("value"))
    spark.dataSource.register(documents.Documents)
    for bad, why in ((rows.repartition(4, "key"), "broken"), (spark.createDataFrame([("a", "1"), ("a", "2")], "key string, value string").coalesce(1), "two documents"), (spark.createDataFrame([(None, "1")], "key string, value string"), "without a key")):
        with pytest.raises(Exception, match=why):
            bad.write.format(documents.NAME).mode("overwrite").save(path)
        assert [p.name for p in tmp_path.iterdir()] == ["d"] and [r.key for r in documents.read_documents(spark, path).collect()] == ["old"]
    with pytest.raises(Exception, match="there already"):
        spark.createDataFrame([("a", "1")], "key string, value string").write.format(documents.NAME).mode("append").save(path)
    assert [p.name for p in tmp_path.iterdir()] == ["d"] and [r.key for r in documents.read_documents(spark, path).collect()] == ["old"]


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    rows = spark.range(5).select("id", F.lit("x").alias("v"))
    for _ in range(2):
        rows.write.mode("append").parquet(src)
        for _ in range(2):
            seen = incremental.ingest(spark, src, rows.schema, out, state, lambda df: df.filter("id > 1"))
    assert seen.count() == 6


def test_ingest_chain(spark):
    sheets = spark.createDataFrame([("7647-14-5", SHEET), ("done", SHEET)], "key string, text string")
    records = spark.createDataFrame([("done", "n", "1-1-1", "c", "v", "solid")], "key string, name string, cas string, category string, vendor_example string, physical_state string")
    row = ingest(sheets, records).first()
    assert row.key == "7647-14-5" and row.cas == "7647-14-5" and row.physical_state == "liquid"
    assert row.flags["is_corrosive"].value and row.flags["is_corrosive"].confidence == "high"
    assert row.flags["is_hygroscopic"].value and row.sds_facts.storage.startswith("Store at 2–8°C")
    assert "corrosive_add_to_water" in [r.id for r in row.rules_fired] and row.status in ("passed", "warned")


def test_upsert_rewrites_changed_buckets_only(spark, tmp_path):
    """1% new keys, one changed value and one new miss rewrite their buckets; what is there already rewrites none."""
    path = tmp_path / "cache"
    rows = {i: (None if i % 5 == 0 else f"v{i}") for i in range(3000)}
    make = lambda d: spark.createDataFrame(list(d.items()), "key long, v string").select("v", "key")
    files = lambda: {f.parent.name: f.name for f in path.rglob("*.parquet")}
    assert buckets.upsert(make({}), str(path)) == [] and not path.exists()
    buckets.upsert(make(rows), str(path), buckets=200)
    before = files()
    assert len(before) == 200
    more = {**{3000 + i: f"n{i}" for i in range(30)}, 7: "other", 8: None, 5: None, 9: "v9"}  # the last two are there
    touched = buckets.upsert(make(more), str(path))
    after = files()
    assert {k for k in after if after[k] != before.get(k)} == {f"{buckets.BUCKET}={b}" for b in touched} and 1 < len(touched) <= 32
    assert {r.key: r.v for r in buckets.entries(spark, str(path)).collect()} == {**rows, **more}
    assert buckets.entries(spark, str(path)).count() == 3030
    assert buckets.upsert(make(more), str(path)) == [] and files() == after


def test_upsert_of_equal_and_null_keys(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "key string, `a.b` string, bucket int")
    path = str(tmp_path / "cache")
    buckets.upsert(make([("x", "1", 1), ("x", None, 9), (None, "n", 0)]), path, buckets=4)
    buckets.upsert(make([(None, None, None), ("y", "2", None), ("y", "2", 3)]), path)
    assert sorted(map(tuple, buckets.entries(spark, path).collect()), key=str) == sorted([("x", "1", 1), (None, None, None), ("y", "2", 3)], key=str)


def test_upsert_that_fails_leaves_the_cache(spark, tmp_path):
    path = str(tmp_path / "cache")
    buckets.upsert(spark.createDataFrame([("x", "1")], "key string, v string"), path, buckets=4)
    with pytest.raises(Exception, match="no value"):
        buckets.upsert(spark.range(3).select(F.lit("x").alias("key"), F.raise_error(F.lit("no value")).cast("string").alias("v")), path)
    assert [tuple(r) for r in buckets.entries(spark, path).collect()] == [("x", "1")]


def test_existing_record_of_a_sheet(spark):
    """By its number alone where it has one, else by its stem; a blank number is none."""
    records = spark.createDataFrame([("50-00-0", "A"), ("goat-serum", "B"), ("12-3", "C")], "key string, name string")
    sheets = spark.createDataFrame([(1, "50-00-0", "goat-serum"), (2, None, "goat-serum"), (3, "", "12-3"), (4, "99-99-9", "50-00-0"), (5, None, None)], "i int, cas string, stem string")
    got = {r.i: (r.cas, r.name) for r in lookups.with_existing(sheets, records).collect()}
    assert got == {1: ("50-00-0", "A"), 2: (None, "B"), 3: ("12-3", "C"), 4: ("99-99-9", None), 5: (None, None)}


def test_point_lookup_fails_without_a_record(spark):
    records = spark.createDataFrame([("x", 1), ("x", 2)], "key string, v int")
    assert lookups.one_record(records, "key", "x").count() == 2
    with pytest.raises(LookupError, match="'y'"):
        lookups.one_record(records, "key", "y")
