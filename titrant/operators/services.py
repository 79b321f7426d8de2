"""What services answer, as tables: substances, synonyms, hits and articles that were fetched before, resolved by joins."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_catalog, is_cas, strip
from .lookups import one_per_key
from .tables import is_article

# What a vendor writes after its catalogue numbers, in the order tried.
SUFFIXES = ("_SIGMA", "_SIAL", "_SIGALD", "")


def valid_articles(papers: DataFrame, xml: str = "xml", key: str = "pmcid") -> DataFrame:
    """``key, valid``: whether a cached file is a whole article. What isn't is for the sink to leave out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "valid": [is_article(None if x is None else bytes(x)) for x in pdf["x"]]})

    kind = papers.schema[key].dataType.simpleString()
    return papers.select(key, F.col(xml).cast("binary").alias("x")).mapInPandas(run, f"{key} {kind}, valid boolean")


def substance_of(rows: DataFrame, substances: DataFrame, identifier: str = "identifier") -> DataFrame:
    """``cid`` of a catalogue number: that of the first suffix under which there is a compound (type 1). ``substances``: ``registry_id, cid, compound_type``."""
    tried = F.posexplode(F.array(*[F.concat(clean_catalog(F.col(identifier)), F.lit(s)) for s in SUFFIXES]))
    known = substances.filter("compound_type = 1 AND cid IS NOT NULL").select("registry_id", "cid")
    numbers = rows.select(identifier).filter(clean_catalog(F.col(identifier)) != "").distinct()
    hits = numbers.select(identifier, tried.alias("o", "registry_id")).join(known, "registry_id")
    return rows.join(one_per_key(hits.select(identifier, "o", "cid"), [identifier], [F.col("o"), F.col("cid")]).select(identifier, "cid"), identifier, "left")


def first_cas(synonyms: DataFrame) -> DataFrame:
    """``cid, cas``: the first synonym that is written as a registry number. ``synonyms``: ``cid, ord, synonym``."""
    return one_per_key(synonyms.filter(is_cas(strip(F.col("synonym")))).select("cid", "ord", strip(F.col("synonym")).alias("cas")), ["cid"], [F.col("ord")]).select("cid", "cas")


def vendor_catalog(substances: DataFrame, vendors: Sequence[str], most: int = 200) -> DataFrame:
    """``cid, catalog``: of a compound's first ``most`` substances, the number of the first that a vendor lists, without its suffix. ``substances``: ``cid, ord, source, registry_id``."""
    listed = substances.filter((F.col("ord") < most) & F.lower("source").rlike("|".join(vendors)))
    return one_per_key(listed.select("cid", "ord", "registry_id"), ["cid"], [F.col("ord")]).select("cid", F.regexp_replace("registry_id", "_[A-Z]+$", "").alias("catalog"))


def first_reviewed(hits: DataFrame, key: str = "key") -> DataFrame:
    """Of each key's hits, the first reviewed one of the first query that has any. ``hits``: ``key, query_ord, hit_ord, reviewed, accession``."""
    good = hits.filter("reviewed").select(key, "query_ord", "hit_ord", "accession")
    return one_per_key(good, [key], [F.col("query_ord"), F.col("hit_ord")]).select(key, "accession")


def tally(hits: DataFrame, flag: str = "flag", hit: str = "hit", shown: int = 2) -> DataFrame:
    """How often each flag was hit, with the least few wordings. What is gathered per flag are its distinct wordings' counts, not its hits."""
    by_wording = hits.groupBy(flag, hit).agg(F.count("*").alias("n"))
    least = by_wording.groupBy(flag).agg(F.sum("n").alias("n"), F.min(hit).alias("first"))
    return least if shown < 2 else least.join(by_wording.join(least.select(flag, "first"), flag).filter(F.col(hit) > F.col("first")).groupBy(flag).agg(F.min(hit).alias("second")), flag, "left")


def change_counts(before: Column, after: Column) -> list[Column]:
    """Counters of a run: rows seen, changed, and what was added to them (both arrays of changes)."""
    added = F.size(F.array_except(after, before))
    return [F.count("*").alias("seen"), F.count_if(added > 0).alias("changed"), F.coalesce(F.sum(added), F.lit(0)).alias("changes")]
