"""Corpus mining: names ranked by how many papers use them, year by year; classes, scaffolds, duplicates, parse counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache
from importlib.resources import files

import yaml
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import reagent_class
from ..functions.first_match import all_of
from ..functions.text import normalize_name, slugify, strip, title_case
from ..schemas import FLAGS
from ..sources.folders import written
from . import fuzzy
from .evidence import placeholder
from .graph import clusters
from .lookups import count_with_fallback, one_per_key


@lru_cache
def names_data() -> dict:
    return yaml.safe_load((files("titrant") / "data" / "names.yaml").read_text(encoding="utf-8"))


def rank_names(rows: DataFrame, paper: str, year: str, name: str, where: Column | None = None, first_year: int = 0, last_year: int = 0, min_papers: int = 5, min_points: int = 3, normalized: bool = False, ascii_only: bool = False) -> DataFrame:
    """``normalized_name, n_papers_total, years_active, annual_counts, annual_norm, mean_norm_freq, trend_slope``.

    A name's frequency in a year is the share of that year's papers that use it. Rows are first reduced to distinct
    (paper, year, name), so that all later counts are sums over partial ones; years outside the bounds (0: none) and
    years that aren't numbers don't count.
    """
    used = rows if where is None else rows.filter(where)
    y = F.col(year).try_cast("double").cast("int")
    used = used.select(F.col(paper).alias("p"), y.alias("y"), (F.col(name) if normalized else normalize_name(F.col(name), ascii_only)).alias("n")).filter("y IS NOT NULL")
    if first_year:
        used = used.filter(F.col("y") >= first_year)
    if last_year:
        used = used.filter(F.col("y") <= last_year)
    per_year = used.groupBy("y").agg(F.count_distinct("p").alias("papers"))
    distinct = used.filter("n <> ''").distinct()
    per_name_year = distinct.groupBy("n", "y").agg(F.count("*").alias("c"))
    total = distinct.select("n", "p").groupBy("n").agg(F.count_distinct("p").alias("n_papers_total"))
    joined = per_name_year.join(per_year, "y").withColumn("f", F.col("c") / F.col("papers"))
    per_name = joined.groupBy("n").agg(
        F.array_sort(F.collect_list(F.struct("y", "c", "f"))).alias("years"), F.round(F.avg("f"), 6).alias("mean_norm_freq"),
        F.when(F.count("*") >= min_points, F.round(F.regr_slope(F.col("f"), F.col("y").cast("double")), 8)).alias("trend_slope"),
    )
    out = per_name.join(total.filter(F.col("n_papers_total") >= min_papers), "n")
    return out.select(
        F.col("n").alias("normalized_name"), "n_papers_total", F.array_join(F.transform("years", lambda s: s["y"].cast("string")), ",").alias("years_active"), F.map_from_entries(F.transform("years", lambda s: F.struct(s["y"], s["c"]))).alias("annual_counts"),
        F.map_from_entries(F.transform("years", lambda s: F.struct(s["y"], F.round(s["f"], 6)))).alias("annual_norm"), "mean_norm_freq", "trend_slope",
    )


def most_common(rows: DataFrame, keys: Sequence[str], value: str, order: str | None = None) -> DataFrame:
    """``keys, value``: the most common value that isn't blank; ties go to the first by ``order``, or else to the least."""
    first = F.min(order) if order else F.lit(0)
    counted = rows.filter(F.coalesce(strip(F.col(value)), F.lit("")) != "").groupBy(*keys, value).agg(F.count("*").alias("c"), first.alias("o"))
    return one_per_key(counted, keys, [-F.col("c"), F.col("o"), F.col(value)]).select(*keys, value)


def sort_ranked(ranked: DataFrame, metric: str = "mean_norm_freq", top: int = 0) -> DataFrame:
    out = ranked.orderBy(F.desc_nulls_last(metric), "normalized_name")
    return out.limit(top) if top else out


def for_csv(ranked: DataFrame) -> DataFrame:
    """Maps as JSON, for a text sink."""
    return ranked.withColumns({c: F.to_json(c) for c in ("annual_counts", "annual_norm")})


# Classes that get a record, with the flags that membership makes true and the note on the missing number.
CLASS_FLAGS = {"serum": ("is_serum", "is_protein"), "enzyme": ("is_protein",), "antibody": ("is_protein", "is_adsorption_prone"), "growth_factor": ("is_protein", "is_adsorption_prone"), "media": ()}
CLASS_NOTES = {"serum": "biological mixture; no single CAS", "enzyme": "recombinant protein or enzyme; CAS unavailable or absent from PubChem", "antibody": "antibody; no CAS", "growth_factor": "recombinant cytokine or growth factor; CAS unavailable or absent from PubChem", "media": "defined mixture (cell culture medium/supplement); no single CAS"}


def scaffold(ranked: DataFrame, existing: DataFrame, order: str = "ord") -> DataFrame:
    """New records for names without a CAS, of a class that gets one, whose slug no record has; of equal slugs, the first."""
    # bound to a variable: filters on the class would repeat its whole chain, which is more than one method of code may hold
    kind = F.get(F.transform(F.array("normalized_name"), lambda c: reagent_class(c)), F.lit(0))
    rows = ranked.filter(F.coalesce("cas", F.lit("")) == "").withColumns({"class": kind, "key": slugify(F.col("normalized_name"))})
    rows = rows.filter(F.col("class").isin(*CLASS_FLAGS)).join(existing.select("key"), "key", "left_anti")
    rows = one_per_key(rows, ["key"], [F.col(order)])
    known = F.create_map(*[x for c, fs in CLASS_FLAGS.items() for x in (F.lit(c), F.array(*[F.lit(f) for f in fs]).cast("array<string>"))])
    member = F.struct(F.lit(True).alias("value"), F.lit("low").alias("confidence"), F.array(F.struct(F.lit("tacit_knowledge").alias("type"), F.concat(F.lit("reagent_class:"), F.col("class")).alias("ref"), F.lit(True).alias("agrees"))).alias("sources"))
    # over an array of the flags, so that the code for one serves all
    entries = F.transform(F.array(*[F.lit(f) for f in FLAGS]), lambda f: F.struct(f.alias("key"), F.when(F.array_contains(known[F.col("class")], f), member).otherwise(placeholder()).alias("value")))
    note = F.create_map(*[F.lit(x) for kv in CLASS_NOTES.items() for x in kv])
    return rows.select(
        "key", F.lit("2.0").alias("schema_version"), title_case(F.col("normalized_name")).alias("name"), F.lit(None).cast("string").alias("cas"), note[F.col("class")].alias("cas_note"), F.lit(None).cast("string").alias("category"),
        F.trim(F.concat_ws(" ", "source", "identifier")).alias("vendor_example"), F.lit("liquid").alias("physical_state"), F.map_from_entries(entries).alias("flags"), "class",
    )


def class_counts(rows: DataFrame, name: str = "normalized_name") -> DataFrame:
    return rows.groupBy(reagent_class(F.col(name)).alias("class")).agg(F.count("*").alias("n"))


# Words that make a product another one. As written, a word must end where a pattern does, so that
# "heat-inactivated" is none of them; the corrected form lets words go on.
_MODIFIERS = r"heat[\s\-]?inactivat|charcoal[\s\-]?strip|dialyz|ultra[\s\-]?low[\s\-]?igg|without[\s\-]?vitamin|no[\s\-]?glucose|high[\s\-]?glucose|low[\s\-]?glucose|growth[\s\-]?factor[\s\-]?reduced|reduced[\s\-]?growth[\s\-]?factor|ldev[\s\-]?free|serum[\s\-]?free|charcoal|pregnant|50x|100x|tetracycline[\s\-]?free|endotoxin[\s\-]?free|insulin[\s\-]?free"


def has_modifier(name: Column, corrected: bool = False) -> Column:
    return name.rlike(rf"(?iuU)\b(?:{_MODIFIERS})" + (r"\w*\b" if corrected else r"\b"))


def _fixed(names: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(names.sparkSession.createDataFrame(rows, schema))


def merge_forms(names: DataFrame, name: str = "name", vendors: DataFrame | None = None, synonyms: DataFrame | None = None) -> DataFrame:
    """``names`` with ``form``, under which duplicates meet: no vendor before it, one name of several, no "solution" after it.

    ``vendors``: ``vendor``; ``synonyms``: ``alias, name``; the package's own lists unless given. Of a name only its first
    words, as far as the longest vendor goes, decide what is cut off; these beginnings, each once however many names have it,
    meet vendors in an equi-join, and the longest vendor found is cut off, so the lists may be of any length. What is cut and
    the aliases are written, so that names are shuffled for neither if it is small. Of an alias with several names the least
    counts. Null and blank vendors and aliases match nothing; the form of a null name is null. Names and lists are compared
    in lower case, without white space around them. ``names`` is read twice.
    """
    data = names_data()
    vendors = _fixed(names, [(v,) for v in data["vendors"]], "vendor string") if vendors is None else vendors
    synonyms = _fixed(names, list(data["synonyms"].items()), "alias string, name string") if synonyms is None else synonyms
    clean = lambda c: strip(F.lower(c))
    known = vendors.select(clean(F.col("vendor")).alias("start")).filter("start <> ''").distinct()
    longest = known.agg(F.coalesce(F.max(F.length("start")), F.lit(0))).first()[0]
    low = clean(F.col(name))
    headed = names.withColumn("__head", F.regexp_extract(F.substr(low, F.lit(1), F.lit(longest + 1)), r"(?Us)\A(.*)\s", 1))
    ends = F.filter(F.sequence(F.lit(1), F.length("__head")), lambda i: F.substr(F.col("__head"), i + 1, F.lit(1)).rlike(r"(?U)\A\s?\z"))
    starts = headed.select("__head").filter("__head <> ''").distinct().select("__head", F.explode(F.transform(ends, lambda i: F.substr(F.col("__head"), F.lit(1), i))).alias("start"))
    cuts = written(starts.join(known, "start").groupBy("__head").agg(F.max(F.length("start")).alias("__cut")), "cuts")
    one = synonyms.select(clean(F.col("alias")).alias("__bare"), clean(F.col("name")).alias("__known")).filter("__bare <> ''").groupBy("__bare").agg(F.min("__known").alias("__known"))
    bare = headed.join(cuts, "__head", "left").withColumn("__bare", strip(F.substr(low, F.coalesce(F.col("__cut"), F.lit(0)) + 1)))
    found = bare.join(written(one, "aliases"), "__bare", "left")
    return found.select(*names.columns, strip(F.regexp_replace(F.coalesce("__known", "__bare"), r"(?i)\s+(?:solution|reagent)$", "")).alias("form"))


def duplicates(names: DataFrame, name: str = "name", n: str = "n", threshold: float = fuzzy.THRESHOLD, corrected_modifiers: bool = False, vendors: DataFrame | None = None, synonyms: DataFrame | None = None, never_merge: DataFrame | None = None) -> DataFrame:
    """``slug, name, n, cluster, canonical, verdict`` (keep or drop). ``vendors``, ``synonyms``: as in ``merge_forms``; ``never_merge``: ``a, b``, pairs of forms.

    Names of one form and modifier are one group; groups whose forms are similar enough and not forbidden are merged. Of
    each cluster the name with the greatest count stays, the first slug on ties. Names are counted once and their forms made
    once; from there on all work is on groups, with their first name each, until verdicts go back to names.
    """
    counted = written(names.select(F.col(name).alias("name"), F.col(n).alias("n")), "names")
    rows = written(merge_forms(counted, "name", vendors, synonyms).withColumns({"slug": slugify(F.col("name")), "modified": has_modifier(F.col("name"), corrected_modifiers)}), "forms")
    first = lambda df, *keys: one_per_key(df.select(*keys, "n", "slug"), keys, [-F.col("n"), F.col("slug")])
    groups = written(first(rows.filter("form IS NOT NULL"), "form", "modified"), "groups")
    never = _fixed(names, [tuple(p) for p in names_data()["never_merge"]], "a string, b string") if never_merge is None else never_merge
    pairs = fuzzy.without_pairs(fuzzy.similar_pairs(groups.select("form").distinct(), "form", threshold), never)
    key = lambda f: F.concat(F.when(F.col("modified"), "1").otherwise("0"), F.col(f))
    ends = groups.select("form", "modified")
    a = ends.withColumnsRenamed({"form": "a"}).join(pairs.select("a", "b"), "a")
    linked = a.join(ends.withColumnsRenamed({"form": "b"}), ["b", "modified"]).select(key("a").alias("u"), key("b").alias("v"))
    found = clusters(linked, "u", "v")
    placed = groups.withColumn("g", key("form")).join(found.withColumnRenamed("node", "g"), "g", "left").withColumn("cluster", F.coalesce("cluster", "g"))
    best = first(placed, "cluster").select("cluster", F.col("slug").alias("canonical"))
    verdicts = written(placed.select("form", "modified", "cluster").join(best, "cluster"), "verdicts")
    out = rows.join(verdicts, ["form", "modified"])
    return out.select("slug", "name", "n", "cluster", "canonical", F.when(F.col("slug") == F.col("canonical"), "keep").otherwise("drop").alias("verdict"))


def with_counts(names: DataFrame, ranked: DataFrame, name: str = "name") -> DataFrame:
    """Paper counts of names, by the name or by its slug read as words."""
    counts = one_per_key(ranked.select(F.col("normalized_name").alias("name"), F.col("n_papers_total").alias("n"), "ord"), ["name"], [-F.col("ord")]).select("name", "n")
    rows = names.withColumns({"__l": F.lower(name), "__s": F.replace(slugify(F.col(name)), F.lit("-"), F.lit(" "))})
    return count_with_fallback(rows, counts, "__l", "__s").drop("__l", "__s")


def sort_by_count(rows: DataFrame, count: str = "n_papers_total", top: int = 0) -> DataFrame:
    """Rows of an all-text table, the greatest count first; what isn't a number counts as 0."""
    out = rows.orderBy(F.coalesce(F.col(count).try_cast("long"), F.lit(0)).desc(), *[c for c in rows.columns if c != count])
    return out.limit(top) if top else out


def parse_funnel(papers: DataFrame, rows: DataFrame, category: str = "") -> DataFrame:
    """One row of counts: papers selected, missing, parsed, with a table, and rows found, kept and their papers.

    ``papers``: ``pmcid, found, xml_ok, tables``; ``rows``: ``pmcid, category``.
    """
    keep = F.lower("category").contains(category.lower()) if category else F.lit(True)
    flag = lambda c, name: c.cast("int").alias(name)
    one = F.lit(True)
    both = papers.select(flag(one, "p"), flag(F.col("found"), "found"), flag(F.col("xml_ok"), "xml"), flag(F.col("tables") > 0, "table"))
    both = both.unionByName(rows.select(flag(one, "r"), flag(keep, "kept"), F.when(keep, F.col("pmcid")).alias("k")), allowMissingColumns=True)
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("long")
    out = both.agg(
        total("p").alias("selected"), (total("p") - total("found")).alias("missing"), total("found").alias("parsed"), total("xml").alias("xml_ok"), total("table").alias("with_table"),
        total("r").alias("raw_rows"), total("kept").alias("kept_rows"), F.count_distinct("k").alias("papers_with_rows"),
    )
    return out.withColumn("table_pct", F.round(100 * F.col("with_table") / F.greatest("parsed", F.lit(1)), 1))


def forward_fill(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, is_heading: Column | None = None) -> DataFrame:
    """The last value that isn't null, by order within the keys; rows that are headings themselves go."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumn(out, F.last(value, ignorenulls=True).over(w))
    return filled if is_heading is None else filled.filter(~is_heading)
