"""Joins by key: caches that remember misses, fallbacks, pending work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.first_match import blank_to_null, first_match
from ..functions.text import clean_catalog, is_cas, strip, truthy


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """The first (or last) row of each key; what remains of a key is decided before the shuffle as far as it can be."""
    top = (F.max if last else F.min)(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c) for c in df.columns if c not in keys]))
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(top.alias("__top")).select(*keys, *[F.col(f"__top.{c}").alias(c) for c in rest]).select(*df.columns)


def crosswalk(rows: DataFrame, cache: DataFrame, identifier: str = "identifier", name: str = "normalized_name") -> DataFrame:
    """``cas`` and ``cas_method`` from a cache (``key, cas, method``) under the catalogue number, else under the name.

    An entry by catalogue number counts only if it has a CAS; one by name counts even without, as a remembered miss.
    """
    side = lambda p: cache.select(F.col("key").alias(f"{p}_key"), F.col("cas").alias(f"{p}_cas"), F.col("method").alias(f"{p}_method"))
    catalog = clean_catalog(F.col(identifier))
    out = rows.withColumns({"__sigma": F.when(catalog != "", F.concat(F.lit("sigma:"), catalog)), "__name": F.concat(F.lit("name:"), strip(F.lower(F.col(name))))})
    out = out.join(side("s"), F.col("__sigma") == F.col("s_key"), "left").join(side("n"), F.col("__name") == F.col("n_key"), "left")
    by_catalog = F.col("s_cas").isNotNull()
    out = out.withColumns({"cas": F.when(by_catalog, F.col("s_cas")).otherwise(F.col("n_cas")), "cas_method": first_match([(by_catalog, F.col("s_method")), (F.col("n_key").isNotNull(), F.col("n_method"))], "not_queried")})
    return out.drop("__sigma", "__name", "s_key", "s_cas", "s_method", "n_key", "n_cas", "n_method")


def coverage(crosswalked: DataFrame) -> DataFrame:
    return crosswalked.agg(F.count("*").alias("total"), F.count_if(F.col("cas").isNotNull()).alias("resolved"), F.count_if(F.col("cas_method") == "not_queried").alias("not_queried"), F.count_if(F.col("cas").isNull() & (F.col("cas_method") != "not_queried")).alias("still_null"))


def uncached(rows: DataFrame, cache: DataFrame, first: str, second: str) -> DataFrame:
    """Rows neither of whose keys the cache has; an empty first key is never there."""
    keys = cache.select("key")
    out = rows.join(keys.withColumnRenamed("key", "__k"), (F.col(first) == F.col("__k")) & (F.col(first) != ""), "left_anti")
    return out.join(keys.withColumnRenamed("key", "__k"), F.col(second) == F.col("__k"), "left_anti")


def cached_only(rows: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """What can be done without asking a service: rows whose key the cache has, remembered misses among them."""
    return rows.join(cache.select(F.col("key").alias(key)), key, "left_semi")


def one_record(records: DataFrame, key: str, value: object) -> DataFrame:
    """The records under one key, which a scan can push down; a key that none has is an error, not an empty result."""
    found = records.filter(F.col(key) == F.lit(value))
    if found.isEmpty():
        raise LookupError(f"no record has {key} {value!r}")
    return found


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return todo.join(done.select(key), key, "left_anti")


def split_downloads(resolved: DataFrame, records: DataFrame, sheets: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Keys without a record: those to download, and those whose sheet is there."""
    left = pending(resolved, records, key)
    return pending(left, sheets, key), left.join(sheets.select(key), key, "left_semi")


def with_orphans(manifest: DataFrame, files: DataFrame, key: str = "pmcid", order: str = "ord") -> DataFrame:
    """Eligible manifest rows, the first of each key, and files that no manifest row names, sorted after them."""
    listed = one_per_key(manifest.filter(truthy(F.col("has_xml")) & truthy(F.col("fetch_ok"))), [key], [F.col(order)])
    orphans = files.select(key).distinct().join(manifest.select(key), key, "left_anti")
    return listed.unionByName(orphans, allowMissingColumns=True)


def fetch_status(fetched: Column, cached: Column) -> Column:
    return first_match([(F.coalesce(cached, F.lit(False)), "cached"), (F.coalesce(fetched, F.lit(False)), "ok")], "miss")


def count_with_fallback(rows: DataFrame, counts: DataFrame, name: str, fallback: str, n: str = "n") -> DataFrame:
    """``n`` by name, else by a second name, else 0. ``counts``: ``name, n``."""
    c = lambda p: counts.select(F.col("name").alias(f"{p}_name"), F.col("n").alias(f"{p}_n"))
    out = rows.join(c("a"), F.col(name) == F.col("a_name"), "left").join(c("b"), F.col(fallback) == F.col("b_name"), "left")
    return out.withColumn(n, F.coalesce("a_n", "b_n", F.lit(0))).drop("a_name", "a_n", "b_name", "b_n")


def record_key(cas: Column, stem: Column) -> Column:
    """The key under which an existing record is sought: its CAS, else a file stem that looks like one, else the stem."""
    return F.coalesce(blank_to_null(cas), F.when(is_cas(stem, loose=True), stem), stem)


def with_existing(sheets: DataFrame, records: DataFrame, cas: str = "cas", stem: str = "stem", key: str = "key") -> DataFrame:
    """Sheets with their ``cas`` (a stem that looks like one stands for a missing one) and the columns of the record that is there already.

    A sheet with a number is sought under it alone, one without under its stem. Blank is missing; sheets without either find none.
    """
    stem_cas = F.when(is_cas(F.col(stem), loose=True), F.col(stem))
    rows = sheets.withColumns({"__key": record_key(F.col(cas), F.col(stem)), cas: F.coalesce(blank_to_null(F.col(cas)), stem_cas)})
    return rows.join(records.withColumnRenamed(key, "__key"), "__key", "left").drop("__key")


def by_either_key(rows: DataFrame, side: DataFrame, first: str, second: str, key: str, value: str) -> DataFrame:
    """``value`` of the row that ``side`` has under the first key, else under the second."""
    s = lambda p: side.select(F.col(key).alias(f"{p}_k"), F.col(value).alias(f"{p}_v"), F.lit(True).alias(f"{p}_there"))
    out = rows.join(s("a"), F.col(first) == F.col("a_k"), "left").join(s("b"), F.col(second) == F.col("b_k"), "left")
    return out.withColumn(value, F.when(F.col("a_there"), F.col("a_v")).otherwise(F.col("b_v"))).drop("a_k", "a_v", "a_there", "b_k", "b_v", "b_there")


def resolve_catalog(rows: DataFrame, cache: DataFrame, by_name: DataFrame) -> DataFrame:
    """A catalogue number and how it was found: cached (even as a miss), inline, by the name's cache, or not at all.

    ``rows``: ``cas, normalized_name, identifier, cas_method``; ``cache``: ``cas, catalog``; ``by_name``: ``name, catalog``.
    """
    out = rows.join(cache.select("cas", F.col("catalog").alias("c_catalog"), F.lit(True).alias("c_there")), "cas", "left")
    out = out.join(by_name.select(F.col("name").alias("normalized_name"), F.col("catalog").alias("n_catalog")), "normalized_name", "left")
    inline = (F.col("cas_method") == "sigma_sid") & (clean_catalog(F.col("identifier")) != "")
    how = first_match([(F.col("c_there"), "cached"), (inline, "inline"), (F.col("n_catalog").isNotNull(), "by_name")], "none")
    return out.withColumns({"catalog": F.when(F.col("c_there"), F.col("c_catalog")).when(inline, clean_catalog(F.col("identifier"))).otherwise(F.col("n_catalog")), "catalog_from": how}).drop("c_catalog", "c_there", "n_catalog")


def registry_status(cas: Column, cid_found: Column, http_ok: Column, names_match: Column) -> Column:
    return first_match([(F.coalesce(cas, F.lit("")) == "", "no_cas"), (~F.coalesce(http_ok, F.lit(False)), "http_error"), (~F.coalesce(cid_found, F.lit(False)), "no_cid"), (~F.coalesce(names_match, F.lit(False)), "name_mismatch")], "ok")


def limited(rows: DataFrame, order: Sequence[Column], n: int, within: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows (0: all), of the table or of each group."""
    if n <= 0:
        return rows
    if not within:
        return rows.orderBy(*order).limit(n)
    w = Window.partitionBy(*within).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def hits_with_total(hits: DataFrame, by: str = "journal", n: str = "hits") -> DataFrame:
    """Sums by group, and a row TOTAL."""
    return hits.rollup(by).agg(F.sum(n).alias(n), F.grouping(by).alias("g")).select(F.when(F.col("g") == 1, F.lit("TOTAL")).otherwise(F.col(by)).alias(by), n)
