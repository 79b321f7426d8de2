"""A training corpus from ``documents``: quality rules, near-dedup, decontamination, personal data, tokens.

Each stage works on all that its predecessor kept, written as Parquet and read again. All but the last return the columns
of ``documents``; the last returns the digest of each remaining document's tokens.

Edge cases: null, empty and blank texts fail the first stage's base rules. Repeated rows, and texts that differ in case or
punctuation only, are near copies, of which one stays; a null doc_id comes before any other. Further columns of
``documents`` go through unchanged, whatever they are called (``n_chars`` follows a masked text). Texts are worked on
whole. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from titrant.llm import bpe_automaton, decontaminate, minhash, pii, quality
from titrant.llm.storage import settled
from titrant.session import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    ship(spark)
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: that with the least doc_id."""
    ship(spark)
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the text, and n_chars follows it."""
    ship(spark)
    return pii.redact(docs, count="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digests of the ids and of the text that they decode to."""
    ship(spark)
    return bpe_automaton.digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: The first stage's compression bands, the classes and the tokens have no SQL; tests hold the first three stages against
#: plain models (words and zstandard, all pairs, windows), the fourth against its patterns, the tokens against the library.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
