"""Registered queries of mining, text functions, sheets and tables, over orders, parts, documents, pages and conversations.

A paper is an order, its year the order's; a name is a part's.
"""

from __future__ import annotations

import uuid
from difflib import SequenceMatcher

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify, sheet, text
from ..operators import fuzzy, mining, rules, tables
from ..sources.folders import shared
from ..streaming import incremental
from .common import HELD, Entry, quoted, spread, sql_values, table, times, values


def name_rows(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").cast("string").alias("year"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), text.normalize_name(F.concat(F.upper("p_name"), F.lit("  ("), F.col("p_type"), F.lit(")")), True).alias("name"))  # once a part, not once a line
    # by paper from here on: what is counted of papers stays where it is, in tasks of a bounded size
    named = spread(lines.join(parts, "l_partkey"), "l_orderkey", HELD, lines)
    return named.join(orders, "l_orderkey").select(F.col("l_orderkey").alias("paper"), "year", "name")


def ranked(spark, sf_dir, **options) -> DataFrame:
    return mining.rank_names(name_rows(spark, sf_dir), "paper", "year", "name", normalized=True, **options)


_SHOWN = ("normalized_name", "n_papers_total", "years_active", "mean_norm_freq", "trend_slope")
_RANK = """u AS (SELECT l_orderkey AS p, year(o_orderdate) AS y, lower(p_name) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey {where}),
py AS (SELECT y, count(DISTINCT p) AS papers FROM u GROUP BY 1), ny AS (SELECT n, y, count(DISTINCT p) AS c FROM u GROUP BY 1, 2), f AS (SELECT n, y, c, CAST(c AS DOUBLE) / papers AS f FROM ny JOIN py USING (y)), t AS (SELECT n, count(DISTINCT p) AS total FROM u GROUP BY 1),
r AS (SELECT n AS normalized_name, total AS n_papers_total, string_agg(CAST(y AS VARCHAR), ',' ORDER BY y) AS years_active, round(avg(f), 6) AS mean_norm_freq, CASE WHEN count(*) >= 3 THEN round(regr_slope(f, CAST(y AS DOUBLE)), 8) END AS trend_slope FROM f JOIN t USING (n) GROUP BY 1, 2)"""


def rank_trend(spark, sf_dir):
    return mining.sort_ranked(ranked(spark, sf_dir)).select(*_SHOWN)


def rank_top_n(spark, sf_dir):
    return mining.sort_ranked(ranked(spark, sf_dir), "n_papers_total", 10).select(*_SHOWN)


def rank_years(spark, sf_dir):
    """Two years only, so there is no slope."""
    return ranked(spark, sf_dir, first_year=1996, last_year=1997, min_papers=20).select(*_SHOWN)


def rank_annual(spark, sf_dir):
    return ranked(spark, sf_dir).select("normalized_name", F.explode("annual_counts").alias("year", "n"))


def most_common_value(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.expr("CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE o_orderpriority END").alias("p"))
    return mining.most_common(o, ["o_custkey"], "p")


def forward_fill_category(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.when((F.col("turn") + F.col("conv_id")) % 3 == 0, F.concat_ws("-", "role", F.col("turn").cast("string"))).alias("h"))
    return mining.forward_fill(c, ["conv_id"], ["turn", "role"], "h", "category", F.col("h").isNotNull()).select("conv_id", "turn", "category")


def normalize_names(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("  "), F.upper("p_name"), F.lit("  "), F.col("p_type"), F.expr("CASE WHEN p_size % 2 = 0 THEN ' (lot 7) ' ELSE ' (' || repeat('x', p_size) || ')' END")).alias("raw"))
    return p.select("p_partkey", text.normalize_name(F.col("raw"), True).alias("name"), text.match_form(F.concat(F.col("raw"), F.lit(" and/or -Others:")), True).alias("form"))


_TRIM = "regexp_replace(regexp_replace({0}, '^\\s+', ''), '\\s+$', '')"
_RAW = "'  ' || upper(p_name) || '  ' || p_type || CASE WHEN p_size % 2 = 0 THEN ' (lot 7) ' ELSE ' (' || repeat('x', p_size) || ')' END"
_NAMES = f"""WITH p AS (SELECT p_partkey, {_RAW} AS raw FROM part), a AS (SELECT p_partkey, regexp_replace({_TRIM.format('lower(raw)')}, '\\s+', ' ', 'g') AS n, lower(raw) || ' and/or -others' AS m FROM p)
SELECT p_partkey, {_TRIM.format("regexp_replace(n, '\\s*\\([^)]{1,30}\\)\\s*$', '')")} AS name, {_TRIM.format("regexp_replace(regexp_replace(regexp_replace(" + _TRIM.format('m') + ", '[,/&\\-]+', ' ', 'g'), '\\s+(and|or)\\s+', ' ', 'g'), '\\s+', ' ', 'g')")} AS form FROM a"""


def slugify(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.slugify(F.col("url")).alias("slug"))


def clean_catalogs(spark, sf_dir):
    """Catalogue numbers written in seven ways."""
    raw = F.expr("CASE p_partkey % 7 WHEN 0 THEN concat('Cat# A', p_partkey) WHEN 1 THEN concat('cat #', p_size) WHEN 2 THEN concat('# ', p_size, '-1') WHEN 3 THEN concat('  cat#Cat#', p_partkey) WHEN 4 THEN concat('X-', p_partkey) WHEN 5 THEN '#' ELSE concat('CAT  # z', p_partkey, ' ') END")
    return table(spark, sf_dir, "part").select("p_partkey", text.clean_catalog(raw).alias("catalog"))


#: What is put after a part's name, and the class that it makes of it.
ENDINGS = (
    (" reduced serum medium", "media"), (" serum", "serum"), (" anti-CD3", "antibody"), (" antimycin a", "other"), (" nuclease-free water", "kit"), (" DNase I", "enzyme"), (" Recombinant mouse IL-6", "growth_factor"), (" penicillin-streptomycin", "media"), (" assay kit", "kit"), (" plasma", "serum"),
    (" plasmid plasma prep", "other"), (" IgG control", "antibody"), (" trypsin-edta", "enzyme"), (" polymerase", "enzyme"), (" chloride", "other"), (" protein gel", "kit"), (" VEGF", "growth_factor"), (" culture medium", "media"), (" prolong gold", "kit"), (" serum albumin", "serum"), (" recombinant trypsin", "enzyme"), (" lipase", "enzyme"), ("", "other"),
)


def named_parts(spark, sf_dir) -> DataFrame:
    ending = F.element_at(F.array(*[F.lit(e) for e, _ in ENDINGS]), (F.col("p_partkey") % len(ENDINGS) + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", ending).alias("name"))


def classify_names(spark, sf_dir):
    return mining.class_counts(named_parts(spark, sf_dir), "name")


def class_each(spark, sf_dir):
    return named_parts(spark, sf_dir).select("p_partkey", classify.reagent_class(F.col("name"), True).alias("class"))


_CLASS = "SELECT p_partkey, CASE p_partkey % " + str(len(ENDINGS)) + " " + " ".join(f"WHEN {i} THEN '{c}'" for i, (_, c) in enumerate(ENDINGS)) + " END AS class FROM part"


def heading_categories(spark, sf_dir):
    """Rows of a table, some of which name a category: by the first cell, if the others are empty, fillers or the same."""
    first = "CASE p_partkey % 8 WHEN 0 THEN concat('Chemicals, Peptides & ', p_name) WHEN 1 THEN concat(p_name, ' antibodies') WHEN 2 THEN concat('EXPERIMENTAL MODELS: CELL LINES OF ', p_type, ':') WHEN 3 THEN concat(p_brand, ' bacterial and virus strains') WHEN 4 THEN '' WHEN 5 THEN concat('Software of ', p_brand) WHEN 6 THEN concat(p_name, ' sgRNA') ELSE p_name END"
    other = "CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN '—' WHEN 2 THEN 'n/a' WHEN 3 THEN p_brand ELSE a END"
    rows = table(spark, sf_dir, "part").withColumn("a", F.expr(first)).withColumn("b", F.expr(other))
    return rows.select("p_partkey", classify.heading_category(F.array("a", "b", F.lit(" * "))).alias("category"))


_HEADING = """SELECT p_partkey, CASE WHEN p_size % 5 <> 3 THEN CASE p_partkey % 8 WHEN 0 THEN 'Chemicals, Peptides, and Recombinant Proteins' WHEN 1 THEN 'Antibodies' WHEN 2 THEN 'Experimental Models: Cell Lines' WHEN 3 THEN 'Bacterial and Virus Strains' WHEN 5 THEN 'Software and Algorithms' WHEN 6 THEN 'Oligonucleotides' END END AS category FROM part"""


def header_roles(spark, sf_dir):
    """Headers with a customer's name before or after what tells their role."""
    h = F.expr("CASE c_custkey % 8 WHEN 0 THEN concat('Resource Type ', c_custkey) WHEN 1 THEN concat(c_name, ' REAGENT or SOURCE') WHEN 2 THEN concat('  Source ', c_name) WHEN 3 THEN concat('Cat# / ', c_name) WHEN 4 THEN concat(c_mktsegment, ' notes') WHEN 5 THEN ' ' WHEN 6 THEN concat(c_custkey, ' Resource') ELSE c_mktsegment END")
    return table(spark, sf_dir, "customer").select("c_custkey", classify.header_role(h).alias("role"))


_ROLES = "SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 'category' WHEN 1 THEN 'reagent' WHEN 2 THEN 'source' WHEN 3 THEN 'identifier' WHEN 4 THEN 'additional' WHEN 6 THEN 'reagent' END AS role FROM customer"

WORDS = (("the", r"\bthe\b"), ("quoted", r"\bof the\b"), ("number", r"\d{3,}"), ("shout", r"!!"), ("mail", r"[a-z]+@"))


def phrase_hits(spark, sf_dir) -> DataFrame:
    """Which of some patterns each whole text has, and what it says first there."""
    rows = F.array(*[F.struct(F.lit(n).alias("phrase"), sheet.snippet(F.col("text"), p).alias("snippet")) for n, p in WORDS])
    return table(spark, sf_dir, "documents").select("doc_id", F.inline(F.filter(rows, lambda r: r["snippet"].isNotNull())))


def phrase_scan(spark, sf_dir):
    return phrase_hits(spark, sf_dir).groupBy("phrase").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


def phrase_tally(spark, sf_dir):
    return phrase_hits(spark, sf_dir).groupBy(F.col("phrase"), F.lower("snippet").alias("snippet")).agg(F.count("*").alias("n"))


_HITS = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS phrase, lower(regexp_extract(text, '{p}', 0, 'i')) AS snippet FROM documents WHERE regexp_matches(text, '{p}', 'i')" for n, p in WORDS)

def hcode_extract(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.format_string("H%03d Some words follow here.\nH%03d Others follow there.", (F.col("c_custkey") % 400 + 100).cast("int"), (F.col("c_custkey") % 37 + 290).cast("int")).alias("s"))
    return c.select("c_custkey", F.array_join(F.transform(sheet.hazards(F.col("s"))["hazard_statements"], lambda x: F.substring(x, 1, 4)), ",").alias("codes"), F.array_join(sheet.pictograms(sheet.hazards(F.col("s"))["hazard_statements"]), ",").alias("pictures"))


_PICTURES = sql_values([(c, n) for n, cs in sheet.PICTOGRAMS for c in cs if not (c == "H241" and n == "exploding_bomb")], "pic", "code, name")
_HCODES = f"""WITH {_PICTURES}, c AS (SELECT c_custkey, 'H' || lpad(CAST(c_custkey % 400 + 100 AS VARCHAR), 3, '0') AS a, 'H' || CAST(c_custkey % 37 + 290 AS VARCHAR) AS b FROM customer)
SELECT c_custkey, CASE WHEN a = b THEN a ELSE a || ',' || b END AS codes, coalesce((SELECT string_agg(DISTINCT name, ',' ORDER BY name) FROM pic WHERE code IN (a, b)), '') AS pictures FROM c"""


def sections_split(spark, sf_dir):
    """Whole documents as a section between others; of two sections with one number, the later."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("head\nSECTION 3. Alpha\n"), F.col("lang"), F.lit("\nSECTION 5. Delta\n"), F.col("text"), F.lit("\nSECTION 12. Beta\nSection 4. no\nSECTION 3. Gamma\n"), F.col("source")).alias("t"))
    return lines.select("doc_id", F.explode(sheet.sections(F.col("t"))).alias("section", "body")).select("doc_id", "section", F.length("body").alias("n_chars"))


#: How a part's size is written, and what it means.
_KINDS = (
    ("t", "concat('70 °F / ', p_size, ' °C')", "p_size"), ("t", "concat('36 - 46 °F / ', p_size, ' - ', p_size + 3, ' °C')", "p_size + 1.5"), ("t", "concat('-', p_size, ' °C')", "-p_size"), ("t", "concat(p_size, ' - ', p_partkey, ' °C')", "round((p_size + p_partkey) / 2.0, 1)"), ("t", "concat('Not applicable ', p_size, ' °C')", "NULL"),
    ("t", "concat('-', p_size + 5, '--', p_size, ' °C')", "NULL"), ("p", "concat(p_size, '.26 hPa (67.3 °F)')", "round((p_size + 0.26) / 10, 4)"), ("p", "concat('< ', p_size, ' hPa (25 °C)')", "round(p_size / 10.0, 4)"), ("p", "concat('No data available ', p_size, ' hPa')", "NULL"), ("p", "concat(p_size, '.5 kPa')", "p_size + 0.5"),
    ("v", "concat(p_size, ',', lpad(p_partkey % 1000, 3, '0'), ' mPa.s')", "p_size * 1000 + p_partkey % 1000"), ("v", "concat(p_size, '.9 mPas')", "p_size + 0.9"), ("v", "concat('no data ', p_size, ' mPa.s')", "NULL"),
)


def numeric_parse(spark, sf_dir):
    """Temperatures, pressures and viscosities as sheets write them."""
    raw = F.expr(f"CASE p_partkey % {len(_KINDS)} " + " ".join(f"WHEN {i} THEN {e}" for i, (_, e, _) in enumerate(_KINDS)) + " END")
    kind = F.expr(f"CASE p_partkey % {len(_KINDS)} " + " ".join(f"WHEN {i} THEN '{k}'" for i, (k, _, _) in enumerate(_KINDS)) + " END")
    v = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"), kind.alias("kind"))
    number = F.when(F.col("kind") == "t", sheet.temperature(F.col("raw"))).when(F.col("kind") == "p", sheet.vapor_pressure(F.col("raw"))).otherwise(sheet.viscosity(F.col("raw")))
    return v.select("p_partkey", "kind", number.alias("number"))


_NUMBERS = f"SELECT p_partkey, CASE p_partkey % {len(_KINDS)} " + " ".join(f"WHEN {i} THEN '{k}'" for i, (k, _, _) in enumerate(_KINDS)) + f" END AS kind, CAST(CASE p_partkey % {len(_KINDS)} " + " ".join(f"WHEN {i} THEN {v}" for i, (_, _, v) in enumerate(_KINDS)) + " END AS DOUBLE) AS number FROM part"


def parse_funnel(spark, sf_dir):
    """Pages as papers, by the blocks they have; one in six can't be found."""
    pages = table(spark, sf_dir, "pages")
    papers = pages.select(F.col("page_id").alias("pmcid"), (F.col("page_id") % 6 != 0).alias("found"), (F.col("html").contains("</html>") & (F.col("page_id") % 6 != 0)).alias("xml_ok"), F.when(F.col("page_id") % 6 != 0, F.size(F.split("html", "<h1>")) - 1).otherwise(0).alias("tables"))
    rows = pages.filter("page_id % 6 <> 0").select(F.col("page_id").alias("pmcid"), F.expr("CASE WHEN url LIKE '%/en/%' THEN 'Chemicals' ELSE 'Other' END").alias("category"))
    return mining.parse_funnel(papers, rows, "Chemical")


_FUNNEL = """WITH p AS (SELECT page_id, page_id % 6 <> 0 AS found, html, url FROM pages)
SELECT count(*) AS selected, CAST(count_if(NOT found) AS BIGINT) AS missing, CAST(count_if(found) AS BIGINT) AS parsed, CAST(count_if(found AND contains(html, '</html>')) AS BIGINT) AS xml_ok, CAST(count_if(found AND contains(html, '<h1>')) AS BIGINT) AS with_table,
CAST(count_if(found) AS BIGINT) AS raw_rows, CAST(count_if(found AND url LIKE '%/en/%') AS BIGINT) AS kept_rows, count(DISTINCT CASE WHEN found AND url LIKE '%/en/%' THEN page_id END) AS papers_with_rows, round(CAST(100 * count_if(found AND contains(html, '<h1>')) AS DOUBLE) / greatest(count_if(found), 1), 1) AS table_pct FROM p"""


def token_overlap(spark, sf_dir):
    """Benchmark items and the words of a list that they share, by whole tokens of four letters or more."""
    return table(spark, sf_dir, "benchmark").select("item_id", text.names_roughly_match(F.col("text"), F.lit("the ther-ing THEN; with, that")).alias("overlap"))


def title_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.title_case(F.concat(F.col("p_name"), F.lit("-3t3 d'x"))).alias("title"))


_TITLE = "SELECT p_partkey, upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] || '-3T3 D''X' AS title FROM part"


def top_pictograms(spark, sf_dir):
    e = table(spark, sf_dir, "part").select("p_partkey", F.array_compact(F.array(*[F.when(F.expr(f"p_size % {k} = 0"), F.lit(n)) for k, n in ((2, "exclamation_mark"), (3, "compressed_gas"), (5, "flame"), (7, "skull_crossbones"))])).alias("p"))
    return e.select("p_partkey", rules.top_pictogram(F.col("p")).alias("top"))


_TOP = "SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'skull_crossbones' WHEN p_size % 5 = 0 THEN 'flame' WHEN p_size % 2 = 0 THEN 'exclamation_mark' WHEN p_size % 3 = 0 THEN 'compressed_gas' END AS top FROM part"

#: An article whose spans and fourth cells vary; every tenth breaks off behind its table, and is read as far as it goes.
ARTICLE = """<article><sec><title>Key resources table</title><table-wrap><table><thead><tr><th colspan="3">Overview</th></tr><tr><th>REAGENT or RESOURCE</th><th>SOURCE</th><th>IDENTIFIER</th></tr></thead><tbody>
<tr><td colspan="3">Antibodies</td></tr><tr><td>anti-{name}</td><td rowspan="{tall}">{brand}</td><td colspan="{wide}">A{key}</td></tr><tr><td>anti-y</td><td>B{size}</td></tr><tr><td>Chemicals</td><td/><td>—</td></tr><tr><td>{name}</td><td>S &amp; T</td><td>1</td><td>{more}</td></tr><tr><td>short</td></tr></tbody></table></table-wrap></sec>"""


def articles(spark, sf_dir) -> DataFrame:
    parts = table(spark, sf_dir, "part").repartition(spark.sparkContext.defaultParallelism, "p_partkey")  # articles are made of one small file, which would be one task
    xml = F.lit(ARTICLE)
    for name, e in {"name": "p_name", "brand": "p_brand", "key": "p_partkey", "size": "p_size", "tall": "1 + p_size % 2", "wide": "1 + p_partkey % 2", "more": "CASE WHEN p_size % 3 = 0 THEN '' ELSE p_type END"}.items():
        xml = F.replace(xml, F.lit("{" + name + "}"), F.expr(f"CAST({e} AS STRING)"))
    return parts.select(F.col("p_partkey").cast("string").alias("pmcid"), F.when(F.col("p_partkey") % 10 == 9, F.concat(xml, F.lit("<sec><p>cut &nosuch; <b"))).otherwise(F.concat(xml, F.lit("</article>"))).alias("xml"))


def grid_expand(spark, sf_dir):
    return tables.table_rows(tables.expand_tables(articles(spark, sf_dir)))


_GRID = """WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS pmcid, *, p_size % 2 = 1 AS tall, p_partkey % 2 = 1 AS wide FROM part), chem(c) AS (VALUES ('Chemicals, Peptides, and Recombinant Proteins'))
SELECT pmcid, 0 AS table_idx, 1 AS row_idx, 'Antibodies' AS category, 'anti-' || p_name AS reagent_name, p_brand AS source, 'A' || p_partkey AS identifier, CASE WHEN wide THEN 'A' || p_partkey ELSE '' END AS additional_info, CASE WHEN wide THEN 'captured_1_extra_cells' ELSE '' END AS parser_warnings FROM p
UNION ALL SELECT pmcid, 0, 2, 'Antibodies', 'anti-y', CASE WHEN tall THEN p_brand ELSE 'B' || p_size END, CASE WHEN tall THEN 'B' || p_size ELSE '' END, '', CASE WHEN tall THEN '' ELSE 'only_2_cells_expected_3' END FROM p
UNION ALL SELECT pmcid, 0, 4, c, p_name, 'S & T', '1', CASE WHEN p_size % 3 = 0 THEN '' ELSE p_type END, CASE WHEN p_size % 3 = 0 THEN '' ELSE 'captured_1_extra_cells' END FROM p, chem
UNION ALL SELECT pmcid, 0, 5, c, 'short', '', '', '', 'only_1_cells_expected_3' FROM p, chem"""


def variant_names(spark, sf_dir) -> DataFrame:
    """Part names behind words that all of them share, with small changes, so that some are similar. Of each, how many parts have it."""
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("recombinant human carrier free "), F.col("p_name")).alias("stem"), (F.col("p_partkey") % 4).alias("v"))
    return p.select(F.concat("stem", F.expr("CASE v WHEN 0 THEN '' WHEN 1 THEN 's' WHEN 2 THEN ' x' ELSE ' solution' END")).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


#: The words that part names are made of, on any scale.
_FIRST, _LAST = ("blue", "cold", "hot", "large", "new", "old", "red", "small"), ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")


def _similar(names: list[str]) -> list[tuple[str, str, float]]:
    """All pairs of names, compared one by one: what the queries are held against."""
    out = []
    for i, b in enumerate(sorted(names)):
        matcher = SequenceMatcher(None, b=b)
        for a in sorted(names)[:i]:
            matcher.set_seq1(a)
            if matcher.real_quick_ratio() >= fuzzy.THRESHOLD and matcher.quick_ratio() >= fuzzy.THRESHOLD and matcher.ratio() >= fuzzy.THRESHOLD:
                out.append((a, b, matcher.ratio()))
    return out


_STEMS = [f"recombinant human carrier free {a} {b}" for a in _FIRST for b in _LAST]
_VARIANTS = """v AS (SELECT 'recombinant human carrier free ' || p_name || CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 's' WHEN 2 THEN ' x' ELSE ' solution' END AS name, count(*) AS n FROM part GROUP BY 1)"""
_PAIRS = sql_values(_similar([s + e for s in _STEMS for e in ("", "s", " x", " solution")]), "near", "a, b, ratio")
_FORMS = sql_values(_similar([s + e for s in _STEMS for e in ("", "s", " x")]), "near", "a, b, ratio")


def fuzzy_pairs(spark, sf_dir):
    return fuzzy.similar_pairs(variant_names(spark, sf_dir))


def dedup_verdict(spark, sf_dir):
    return mining.duplicates(variant_names(spark, sf_dir)).select("slug", "n", "canonical", "verdict")


_DEDUP = f"""WITH RECURSIVE {_VARIANTS}, {_FORMS}, f AS (SELECT name, n, replace(name, ' ', '-') AS slug, regexp_replace(name, ' solution$', '') AS form FROM v),
link AS (SELECT a, b FROM near WHERE a IN (SELECT form FROM f) AND b IN (SELECT form FROM f) UNION ALL SELECT b, a FROM near WHERE a IN (SELECT form FROM f) AND b IN (SELECT form FROM f)),
reach(form, other) AS (SELECT form, form FROM f UNION SELECT r.form, link.b FROM reach r JOIN link ON r.other = link.a),
c AS (SELECT form, min(other) AS cluster FROM reach GROUP BY 1), every AS (SELECT slug, n, cluster FROM f JOIN c USING (form)),
best AS (SELECT cluster, slug AS canonical FROM every QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, slug) = 1)
SELECT slug, n, canonical, CASE WHEN slug = canonical THEN 'keep' ELSE 'drop' END AS verdict FROM every JOIN best USING (cluster)"""


#: How lines name what they sell: behind a supplier, modified, with an ending, or by another name.
_CALLED = """CASE (l_partkey + l_suppkey) % 4 WHEN 0 THEN '' WHEN 1 THEN concat(s_name, '  ') WHEN 2 THEN concat(upper(s_name), ' Labs ') ELSE concat(' ', lower(s_name), ' ') END,
CASE WHEN l_partkey % 11 = 0 THEN concat('Alias of ', p_name) ELSE concat(CASE l_partkey % 5 WHEN 0 THEN '50x ' WHEN 1 THEN '5x ' ELSE '' END, 'Recombinant human carrier ', p_name, CASE l_partkey % 7 WHEN 0 THEN 's' WHEN 1 THEN ' x' WHEN 2 THEN ' Solution' WHEN 3 THEN ' reagent' ELSE '' END) END"""


def dedup_products(spark, sf_dir):
    """Names behind suppliers' names, with suppliers, aliases and pairs that mustn't meet as tables."""
    lines, parts, suppliers = (table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier"))
    names = lines.join(parts, F.expr("l_partkey = p_partkey")).join(suppliers, F.expr("l_suppkey = s_suppkey")).groupBy(F.expr(f"concat({_CALLED})").alias("name")).agg(F.count("*").alias("n"))
    vendors = suppliers.select(F.col("s_name").alias("vendor")).union(suppliers.filter("s_suppkey % 2 = 0").select(F.concat("s_name", F.lit(" LABS"))))
    synonyms = parts.filter("length(p_name) % 2 = 0").select(F.concat(F.lit("alias of "), "p_name").alias("alias"), F.concat(F.lit("Recombinant human carrier "), "p_name").alias("name"))
    stem = F.concat(F.lit("recombinant human carrier "), "p_name")
    never = parts.filter("p_name < 'l'").select(F.concat(stem, F.lit("s")).alias("a"), stem.alias("b")).distinct()
    return mining.duplicates(names, vendors=vendors, synonyms=synonyms, never_merge=never).select("slug", "n", "canonical", "verdict")


#: Similar forms: at most two characters of both without a partner, as they are all shorter than 50.
_PRODUCTS = f"""WITH RECURSIVE names AS (SELECT concat({_CALLED}) AS name, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
vendors AS (SELECT lower(s_name) AS v FROM supplier UNION SELECT lower(s_name) || ' labs' FROM supplier WHERE s_suppkey % 2 = 0),
low AS (SELECT name, n, trim(lower(name)) AS l FROM names), cuts AS (SELECT name, max(length(v)) AS cut FROM low JOIN vendors ON starts_with(l, v || ' ') GROUP BY 1),
bare AS (SELECT name, n, trim(substr(l, coalesce(cut, 0) + 1)) AS m FROM low LEFT JOIN cuts USING (name)),
f AS (SELECT name, n, regexp_replace(CASE WHEN starts_with(m, 'alias of ') AND length(m) % 2 = 1 THEN 'recombinant human carrier ' || substr(m, 10) ELSE m END, ' (solution|reagent)$', '') AS form, regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, regexp_matches(lower(name), '\\b50x\\b') AS modified FROM bare),
g AS (SELECT DISTINCT form, modified, length(form) AS c, list_transform(range(1, length(form) + 1), lambda i: form[:i - 1] || form[i + 1:]) AS less FROM f),
near AS (SELECT a.form AS a, b.form AS b, a.modified FROM g a JOIN g b ON a.modified = b.modified AND a.form <> b.form AND abs(a.c - b.c) <= 2 WHERE levenshtein(a.form, b.form) <= 2
  AND CASE WHEN a.c = b.c THEN 200 <= 3 * (a.c + b.c) AND list_has_any(a.less, b.less) ELSE levenshtein(a.form, b.form) = abs(a.c - b.c) AND 100 * abs(a.c - b.c) <= 3 * (a.c + b.c) END
  AND NOT ((b.form = a.form || 's' OR a.form = b.form || 's') AND least(a.form, b.form) IN (SELECT 'recombinant human carrier ' || p_name FROM part WHERE p_name < 'l'))),
reach(form, modified, other) AS (SELECT form, modified, form FROM g UNION SELECT r.form, r.modified, near.b FROM reach r JOIN near ON r.other = near.a AND r.modified = near.modified),
c AS (SELECT form, modified, min(other) AS cluster FROM reach GROUP BY 1, 2), every AS (SELECT slug, n, modified, cluster FROM f JOIN c USING (form, modified)),
best AS (SELECT modified, cluster, slug AS canonical FROM every QUALIFY row_number() OVER (PARTITION BY modified, cluster ORDER BY n DESC, slug) = 1)
SELECT slug, n, canonical, CASE WHEN slug = canonical THEN 'keep' ELSE 'drop' END AS verdict FROM every JOIN best USING (modified, cluster)"""


def scaffold_records(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("anti-"), "p_name").alias("normalized_name"), F.col("p_brand").alias("source"), F.col("p_size").cast("string").alias("identifier"), F.lit("").alias("cas"), F.col("p_partkey").alias("ord"))
    out = mining.scaffold(rows, values(spark, [("anti-red-bolt",)], "key string"))
    true = F.filter(F.map_entries("flags"), lambda e: e["value"]["value"])
    return out.select("key", "name", "class", "vendor_example", F.array_join(F.array_sort(F.transform(true, lambda e: e["key"])), ",").alias("true_flags"), F.size("flags").alias("n_flags"))


_SCAFFOLD = """SELECT 'anti-' || replace(p_name, ' ', '-') AS key, 'Anti-' || upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS name, 'antibody' AS class, p_brand || ' ' || CAST(p_size AS VARCHAR) AS vendor_example, 'is_adsorption_prone,is_protein' AS true_flags, 25 AS n_flags
FROM part WHERE p_name <> 'red bolt' QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1"""


def events_incremental(spark, sf_dir):
    """Events taken in as a stream that ends when all files are seen, then summed; a second run adds nothing."""
    folder = f"{shared(spark)}/events-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "events").schema
    for _ in range(2):
        seen = incremental.ingest(spark, f"{sf_dir}/events.parquet*", schema, f"{folder}/out", f"{folder}/state", lambda df: df.filter("value > 10").select("event_id", "user_id", "event_type", "value"))
    return seen.groupBy("event_type").agg(F.count("*").alias("n_events"), F.round(F.sum("value"), 2).alias("total_value"))


def events_windows(spark, sf_dir):
    out = incremental.windowed_counts(table(spark, sf_dir, "events"), width="1 day")
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n_events", F.round("total_value", 2).alias("total_value"))


ENTRIES: dict[str, Entry] = {
    "rank_trend": (rank_trend, f"WITH {_RANK.format(where='')} SELECT * FROM r WHERE n_papers_total >= 5"),
    "rank_top_n": (rank_top_n, f"WITH {_RANK.format(where='')} SELECT * FROM r WHERE n_papers_total >= 5 ORDER BY n_papers_total DESC, normalized_name LIMIT 10"),
    "rank_years": (rank_years, f"WITH {_RANK.format(where='WHERE year(o_orderdate) BETWEEN 1996 AND 1997')} SELECT * FROM r WHERE n_papers_total >= 20"),
    "rank_annual": (rank_annual, f"WITH {_RANK.format(where='')} SELECT n AS normalized_name, CAST(y AS INTEGER) AS year, c AS n FROM ny JOIN t USING (n) WHERE total >= 5"),
    "most_common_value": (most_common_value, "SELECT o_custkey, o_orderpriority AS p FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) = 1"),
    "forward_fill_category": (forward_fill_category, "WITH c AS (SELECT conv_id, turn, role, CASE WHEN (turn + conv_id) % 3 = 0 THEN role || '-' || CAST(turn AS VARCHAR) END AS h FROM conversations) SELECT conv_id, turn, category FROM (SELECT *, last_value(h IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS UNBOUNDED PRECEDING) AS category FROM c) WHERE h IS NULL"),
    "normalize_names": (normalize_names, _NAMES),
    "slugify": (slugify, "SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM pages"),
    "clean_catalogs": (clean_catalogs, "SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'A' || p_partkey WHEN 1 THEN CAST(p_size AS VARCHAR) WHEN 2 THEN p_size || '-1' WHEN 3 THEN 'Cat#' || p_partkey WHEN 4 THEN 'X-' || p_partkey WHEN 5 THEN '' ELSE 'z' || p_partkey END AS catalog FROM part"),
    "classify_names": (classify_names, f"SELECT class, count(*) AS n FROM ({_CLASS}) GROUP BY 1"),
    "class_each": (class_each, _CLASS),
    "heading_categories": (heading_categories, _HEADING),
    "header_roles": (header_roles, _ROLES),
    "phrase_scan": (phrase_scan, f"WITH h AS ({_HITS}) SELECT phrase, count(*) AS n, min(doc_id) AS first_doc FROM h GROUP BY 1"),
    "phrase_tally": (phrase_tally, f"WITH h AS ({_HITS}) SELECT phrase, trim(snippet[1:60]) AS snippet, count(*) AS n FROM h GROUP BY 1, 2"),
    "hcode_extract": (hcode_extract, _HCODES),
    "sections_split": (sections_split, "SELECT doc_id, 3 AS section, CAST(length(source) + 5 AS INTEGER) AS n_chars FROM documents UNION ALL SELECT doc_id, 5, CAST(length(text) + 6 AS INTEGER) FROM documents UNION ALL SELECT doc_id, 12, 18 FROM documents"),
    "numeric_parse": (numeric_parse, _NUMBERS),
    "parse_funnel": (parse_funnel, _FUNNEL),
    "token_overlap": (token_overlap, r"SELECT item_id, len(list_intersect(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: length(t) >= 4), ['ther', 'then', 'with', 'that'])) > 0 AS overlap FROM benchmark"),
    "title_names": (title_names, _TITLE),
    "top_pictograms": (top_pictograms, _TOP),
    "grid_expand": (grid_expand, _GRID),
    "fuzzy_pairs": (fuzzy_pairs, f"WITH {_VARIANTS}, {_PAIRS} SELECT a, b, ratio FROM near WHERE a IN (SELECT name FROM v) AND b IN (SELECT name FROM v)"),
    "dedup_verdict": (dedup_verdict, _DEDUP),
    "dedup_products": (dedup_products, _PRODUCTS),
    "scaffold_records": (scaffold_records, _SCAFFOLD),
    "events_incremental": (events_incremental, "SELECT event_type, count(*) AS n_events, round(sum(value), 2) AS total_value FROM events WHERE value > 10 GROUP BY 1"),
    "events_windows": (events_windows, "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n_events, round(sum(value), 2) AS total_value FROM events GROUP BY 1, 2"),
}
