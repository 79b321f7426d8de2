import hashlib
import itertools
import random
import re
import time
from difflib import SequenceMatcher
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from titrant.operators import fuzzy, lookups, mining, tables
from titrant.operators.graph import clusters


def test_rank(spark):
    rows = []
    shares = {2019: 1, 2020: 3, 2021: 2, 2022: 5}
    for year, n in shares.items():
        rows += [(f"{year}-{i}", str(year), "Tris  (pH 8)" if i < n else "other") for i in range(10)]
        rows.append((f"{year}-0", str(year), "TRIS"))  # the same paper and name again
    rows.append(("bad", "n/a", "tris"))
    got = {r.normalized_name: r for r in mining.rank_names(spark.createDataFrame(rows, "p string, y string, n string"), "p", "y", "n").collect()}
    assert got["tris"].trend_slope == 0.11 and got["tris"].n_papers_total == 11 and got["tris"].annual_counts == {2019: 1, 2020: 3, 2021: 2, 2022: 5}
    assert got["tris"].years_active == "2019,2020,2021,2022" and got["tris"].mean_norm_freq == 0.275
    two = mining.rank_names(spark.createDataFrame(rows, "p string, y string, n string"), "p", "y", "n", first_year=2019, last_year=2020, min_papers=1)
    assert all(r.trend_slope is None for r in two.collect())
    assert mining.rank_names(spark.createDataFrame([], "p string, y string, n string"), "p", "y", "n").count() == 0


def test_fuzzy_is_exact(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcde ") for _ in range(rng.randint(5, 60))) for _ in range(40)]
    names = set(base)
    for s in base:
        for _ in range(4):
            t = list(s)
            for _ in range(rng.randint(1, 2)):
                i = rng.randrange(len(t))
                t[i : i + 1] = rng.choice([[], [rng.choice("xyz")], [t[i], "q"]])
            names.add("".join(t) or "z")
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    for threshold in (0.97, 0.9):
        want = {(a, b) for a in names for b in names if a < b and SequenceMatcher(None, a, b).ratio() >= threshold}
        assert {(r.a, r.b) for r in fuzzy.similar_pairs(frame, threshold=threshold).collect()} == want


def test_shared_words_are_no_keys(spark):
    """Names that all begin alike meet by what tells them apart: the candidates stay few."""
    names = [f"recombinant human {a} {hashlib.md5(bytes([i])).hexdigest()[:10]}{e}" for i in range(200) for a in ("alpha", "omega") for e in ("", "s")]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    want = {tuple(sorted((a, b))) for a, b in itertools.combinations(names, 2) if SequenceMatcher(None, *sorted((a, b))).ratio() >= 0.97}
    assert {(r.a, r.b) for r in fuzzy.similar_pairs(frame).collect()} == want
    assert len(want) >= 400 and fuzzy.candidates(frame).count() < 2 * len(want)


def test_malformed_xml_is_read_as_far_as_it_goes():
    got = tables.recovered("<?xml version='1.0'?><!DOCTYPE a [<!ENTITY x 'y'>]><a:b k='1&lt;2' q><c>one &nosuch;&#65;&amp;</d><e/>two<f>thr<![CDATA[<ee>]]> </c> tail <!-- <g> -->")
    assert got.tag == "b" and got.attrib == {"k": "1<2"} and "".join(got.itertext()) == "one A&twothr<ee>  tail "
    assert [e.tag for e in got.iter()] == ["b", "c", "e", "f"]
    assert tables.recovered("<broken") is None and tables.recovered(b"\xff") is None and tables.parse_xml("<a><b></a>") is None
    assert tables.recovered("<a/><b/>").tag == "a" and len(tables.recovered("<a>x</a><b/>")) == 0


def test_duplicates(spark):
    rows = [("Fetal Bovine Serum", 50), ("FBS", 70), ("gibco fbs", 5), ("heat-inactivated fbs", 3), ("charcoal-stripped fbs", 4), ("recombinant mouse m-csf", 9), ("recombinant mouse gm-csf", 8), ("trizol reagent", 2), ("TRI reagent", 2)]
    got = {r.name: r for r in mining.duplicates(spark.createDataFrame(rows, "name string, n long")).collect()}
    assert got["FBS"].verdict == "keep" and got["Fetal Bovine Serum"].canonical == "fbs" and got["gibco fbs"].verdict == "drop"
    assert got["charcoal-stripped fbs"].verdict == "keep"
    assert got["recombinant mouse m-csf"].verdict == got["recombinant mouse gm-csf"].verdict == "keep"  # similar, but a forbidden pair
    assert [got[n].verdict for n in ("TRI reagent", "trizol reagent")] == ["keep", "drop"]
    mod = spark.createDataFrame([("heat-inactivated fbs",), ("charcoal-stripped fbs",), ("serum-free medium",)], "n string")
    assert [r.x for r in mod.select(mining.has_modifier(F.col("n")).alias("x")).collect()] == [False, True, True]
    assert [r.x for r in mod.select(mining.has_modifier(F.col("n"), corrected=True).alias("x")).collect()] == [True, True, True]


def test_merge_forms(spark):
    names = spark.createDataFrame([("Acme  Labs\u00a0Tris solution", 1), ("acme tris", 2), ("ACME", 3), ("acmetris", 4), ("acme lab Tris", 5), (None, 6), (" ", 7), ("acme alias", 8), ("acme  labs tris Reagent", 9), ("acme tris", 2)], "label string, k int")
    vendors = spark.createDataFrame([("Acme",), (" acme  labs ",), (None,), ("",), ("a" * 5000,)], "vendor string")
    synonyms = spark.createDataFrame([("Alias", "tris"), ("ALIAS", "zinc"), (None, "x"), ("", "y")], "alias string, name string")
    got = sorted(((r.k, r.form) for r in mining.merge_forms(names, "label", vendors, synonyms).collect()))
    assert got == [(1, "tris"), (2, "tris"), (2, "tris"), (3, "acme"), (4, "acmetris"), (5, "lab tris"), (6, None), (7, ""), (8, "tris"), (9, "tris")]
    assert mining.merge_forms(names.limit(0), "label", vendors.limit(0), synonyms.limit(0)).count() == 0
    assert {r.form for r in mining.merge_forms(names.filter("k = 2"), "label", vendors.limit(0), synonyms.limit(0)).collect()} == {"acme tris"}


def test_forms_are_those_of_the_longest_vendor(spark):
    """Beginnings that many names share, vendors of several words, any white space: as one by one."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab\u00e9") for _ in range(rng.randrange(1, 3)))
    gap = lambda: rng.choice([" ", " ", "  ", "\t", "\u00a0"])
    label = lambda n: "".join(word() + gap() for _ in range(n))
    names = sorted({label(rng.randrange(1, 6)) + rng.choice(["", "a", "solution"]) for _ in range(300)})
    vendors = [label(rng.randrange(1, 4)).upper() for _ in range(40)]

    def form(name):
        low = name.lower().strip()
        cut = max((len(v) for v in (x.lower().strip() for x in vendors) if low.startswith(v) and low[len(v) : len(v) + 1].isspace()), default=0)
        return re.sub(r"(?a:\s)+solution$", "", low[cut:].strip()).strip()

    got = mining.merge_forms(spark.createDataFrame([(n,) for n in names], "name string"), vendors=spark.createDataFrame([(v,) for v in vendors], "vendor string"), synonyms=spark.createDataFrame([], "alias string, name string"))
    assert {r.name: r.form for r in got.collect()} == {n: form(n) for n in names}


def test_names_are_counted_once(spark):
    """What the names are made of is read once, however many steps need them."""
    seen = spark.sparkContext.accumulator(0)

    def made(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    names = spark.range(200).selectExpr("concat('fbs ', id % 40, ' of ', id) AS name", "id AS n").mapInArrow(made, "name string, n long")
    assert mining.duplicates(names).count() == 200 and seen.value == 200


def test_clusters(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, 200), (200, 150)]
    got = {r.node: r.cluster for r in clusters(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 150: 100, 200: 100}


ARTICLE = """<article xmlns="urn:x"><table-wrap><label>Key  Resource Table</label><table><thead><tr><th colspan="2">Top</th></tr><tr><th>Resource Type</th><th>Reagent</th><th>Source</th><th>Identifier</th></tr></thead>
<tbody><tr><td rowspan="2">Antibodies</td><td>a</td><td colspan="2">v</td></tr><tr><td>b</td><td rowspan="x">w</td><td>2</td></tr><tr><td>Odd</td><td>c</td></tr><tr><td/><td>Reagent</td><td>s</td><td>i</td></tr></tbody></table></table-wrap>
<table-wrap><label>Another</label><table><tr><td>no</td></tr></table></table-wrap></article>"""


def test_tables(spark):
    papers = spark.createDataFrame([("p1", ARTICLE), ("p2", "<broken"), ("p3", "<article/>"), ("p4", None)], "pmcid string, xml string")
    grid = tables.expand_tables(papers).cache()
    assert {(r.pmcid, r.xml_ok, r.tables) for r in tables.paper_counts(grid).collect()} == {("p1", True, 1), ("p2", False, 0), ("p3", True, 0), ("p4", False, 0)}
    got = [(r.category, r.reagent_name, r.source, r.identifier, r.parser_warnings) for r in tables.table_rows(grid).orderBy("row_idx").collect()]
    assert got == [("Antibodies", "a", "v", "v", ""), ("Antibodies", "b", "w", "2", ""), ("Odd", "c", "", "", "only_2_cells_expected_4")]
    assert tables.is_article(ARTICLE.encode()) and not tables.is_article(b"<article/>") and not tables.is_article(b"<p>" + b"x" * 300 + b"</p>") and not tables.is_article(None)


def test_lookups(spark):
    rows = spark.createDataFrame([(1, "Cat# 5", "A"), (2, "6", "B"), (3, "", "C"), (4, "9", "A")], "k int, identifier string, normalized_name string")
    cache = spark.createDataFrame([("sigma:5", "c5", "sid"), ("sigma:6", None, "sid"), ("name:b", None, "miss"), ("name:a", "ca", "cid")], "key string, cas string, method string")
    out = lookups.crosswalk(rows, cache)
    assert [(r.k, r.cas, r.cas_method) for r in out.orderBy("k").collect()] == [(1, "c5", "sid"), (2, None, "miss"), (3, None, "not_queried"), (4, "ca", "cid")]
    assert tuple(lookups.coverage(out).first()) == (4, 2, 1, 1)


def test_services(spark):
    from titrant.operators import services

    papers = spark.createDataFrame([("a", ARTICLE), ("b", "<x/>"), ("c", None)], "pmcid string, xml string")
    assert {tuple(r) for r in services.valid_articles(papers).collect()} == {("a", True), ("b", False), ("c", False)}
    rows = spark.createDataFrame([("Cat# 1",), ("2",), ("",), ("3",)], "identifier string")
    known = spark.createDataFrame([("1", 10, 1), ("1_SIAL", 11, 1), ("1_SIGMA", 12, 2), ("2", None, 1)], "registry_id string, cid long, compound_type int")
    assert {tuple(r) for r in services.substance_of(rows, known).collect()} == {("Cat# 1", 11), ("2", None), ("", None), ("3", None)}
    hits = spark.createDataFrame([("k", 1, 0, True, "late"), ("k", 0, 5, True, "early"), ("k", 0, 1, False, "no")], "key string, query_ord int, hit_ord int, reviewed boolean, accession string")
    assert services.first_reviewed(hits).first().accession == "early"


def test_clusters_of_chains_stars_and_trees(spark, monkeypatch):
    """Random graphs against a plain union of sets; a chain in rounds that grow with its logarithm, a star in two; only what is read stays on disk."""
    from titrant.operators import graph

    made: list = []
    keep = graph.written
    monkeypatch.setattr(graph, "written", lambda df, name: made.append((name, keep(df, name))) or made[-1][1])
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(255)] + [(5000, 5001 + i) for i in range(500)] + [(7, 7), (None, 3), (9001, 9000), (9000, 9001)]
    root = {x: x for p in pairs for x in p if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in pairs:
        if None not in (u, v) and find(u) != find(v):
            root[max(find(u), find(v))] = min(find(u), find(v))
    linked = {x for u, v in pairs if None not in (u, v) and u != v for x in (u, v)}
    got = {r.node: r.cluster for r in graph.clusters(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in linked}
    assert sum(name == "moves" for name, _ in made) <= 14
    there = [t.written_at for _, t in made if Path(t.written_at.removeprefix("file://")).exists()]
    assert there == [made[-1][1].written_at]
    made.clear()
    star = spark.range(1, 3001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    assert graph.clusters(star, "a", "b").filter("cluster = 0").count() == 3001 and sum(name == "moves" for name, _ in made) <= 3
    assert graph.clusters(star.limit(0), "a", "b").count() == 0


HOSTILE = {
    "comments": "<a>" + "<!--" * 20_000, "instructions": "<a>" + "<?x " * 20_000, "sections": "<a>" + "<![CDATA[" * 20_000, "types": "<!DOCTYPE [" * 20_000 + "<a>", "opens": "<b>" * 20_000, "closed": "<b>" * 10_000 + "</c>" * 10_000,
    "crossed": "<b><c>" * 5_000 + "</b>" * 5_000 + "</c>" * 5_000, "texts": "<a>" + "x<!---->" * 20_000, "brackets": "<" * 80_000, "quotes": "<a " + "b='" * 20_000, "empty": "<a>" + "<b/>" * 20_000, "names": "<a " + "x=" * 40_000 + ">", "references": "<a>" + "&" * 80_000,
}


@pytest.mark.parametrize("kind", HOSTILE)
def test_recovery_is_linear(kind):
    """Four times the page takes about four times as long (a quadratic pass took sixteen): seconds in all, where one took minutes."""
    page = HOSTILE[kind]
    began = time.process_time()
    tables.recovered(page * 4 if kind != "closed" else "<b>" * 40_000 + "</c>" * 40_000)
    assert time.process_time() - began < 5


def test_recovery_keeps_what_never_ends_as_text():
    got = tables.recovered("<a>1<!-- 2<b>3</b>4")
    assert "".join(got.itertext()) == "1<!-- 234" and [c.tag for c in got] == ["b"]
    assert tables.recovered("<!DOCTYPE x [ <y> <a>z</a>").tag == "y"


def spread(*trs):
    return list(tables.expand(tables.ET.fromstring(f"<t>{''.join(f'<tr>{r}</tr>' for r in trs)}</t>")))


def test_spans_that_meet():
    """A cell covers a column that is held from above, which goes on below; widths beyond what HTML allows are cut."""
    assert spread("<td>a</td><td rowspan='3'>b</td><td>c</td>", "<td colspan='3'>wide</td>", "<td>d</td><td>e</td>", "<td>f</td>", "<td>g</td>") == [["a", "b", "c"], ["wide"] * 3, ["d", "b", "e"], ["f", "b"], ["g"]]
    assert spread("<td>a</td><td rowspan='2'>b</td>", "<td colspan='2' rowspan='2'>both</td>", "<td>c</td>") == [["a", "b"], ["both", "both"], ["both", "both", "c"]]
    (row,) = spread("<td colspan='1000000000'>x</td><td>y</td>")
    assert len(row) == 1001 and set(row[:1000]) == {"x"} and row[-1] == "y"
    assert spread("<td rowspan='99999999999'>x</td>", "<td>y</td>") == [["x"], ["x", "y"]]


def test_rows_come_one_by_one(spark):
    """A table of many rows is never held: the first rows are there while the rest is still markup, and all arrive through the plan."""
    big = "<article><table-wrap><label>Key resources table</label><table><tbody>" + "<tr><td rowspan='2'>a</td><td>b</td></tr>" * 30_000 + "</tbody></table></table-wrap></article>"
    rows = tables.grid_rows("p", big)
    assert next(rows)[-2:] == (0, ["a", "b"]) and iter(rows) is rows
    frame = spark.createDataFrame([("p", big), ("none", None), (None, "<article/>"), ("cut", big[:400])], "pmcid string, xml string")
    got = tables.expand_tables(frame).groupBy("pmcid").agg(F.count("cells").alias("n"), F.max("n_tables").alias("t"), F.bool_and("xml_ok").alias("ok"))
    assert {r.pmcid: (r.n, r.t, r.ok) for r in got.collect()} == {"p": (30_000, 1, True), "none": (0, 0, False), None: (0, 0, True), "cut": (8, 1, True)}
    plan = tables.expand_tables(frame)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDTF" in plan and "mapInPandas" not in plan


def test_named_tables():
    root = tables.ET.fromstring("<a><sec><title>Key Resources Table</title><x><table-wrap id='1'><label>T</label></table-wrap></x></sec><table-wrap id='2'><caption><p>the key resource table</p></caption></table-wrap><table-wrap id='3'/><table-wrap id='4'><b><label>key resources table</label></b></table-wrap></a>")
    assert [(t.get("id"), w) for t, w in tables.key_tables(root)] == [("1", "section"), ("2", "caption"), ("4", "label")]


def test_ranked_rows_lie_in_tasks_of_a_bounded_size(spark, monkeypatch):
    """However few bytes a shuffle has, its rows are dealt by their number."""
    from titrant.plans import corpus_queries

    monkeypatch.setattr(corpus_queries, "HELD", 200, raising=False)
    rows = corpus_queries.name_rows(spark, "/root/testdata/sf0.001")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert rows.count() == lines and rows.rdd.getNumPartitions() == -(-lines // 200)
