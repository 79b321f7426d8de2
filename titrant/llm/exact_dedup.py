"""Exact duplicates by skew-safe combining, in built-in functions only.

Texts are equal when they are identical after every run of white space has become one space. Three stages, each comparing
full contents beside the digest:

1. every task deduplicates what it reads (the map side of the first aggregation),
2. what tasks with the same salt found is merged, by salt, digest and text, so a text that every task holds goes to
   ``SALTS`` places instead of one,
3. the salts' winners, ``SALTS`` rows a text at most, are combined by digest and text.

The winners (digest, the least id, the number of rows) are written without their texts. Rows find their winner by digest;
a digest that several texts share, if there ever is one, is looked up by text too. Groups with more than one in
``HEAVY`` of all rows, of which there can't be more than ``HEAVY``, are broadcast; all others meet in a shuffled join.

Edge cases: a null text is an empty one. A null id comes before no other: the row that stays is that with the least id
that isn't null, and the group's ``keep_id`` is null only if all its ids are. Of repeated rows that all have the least
id, one is marked as kept. Texts are compared whole, however long. An empty table gives no rows. Columns besides id and
text, whatever they are called, don't matter to ``mark``; ``keep_first`` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import unused
from .storage import settled

SALTS = 32
#: A group is heavy with more than one in so many rows, so there are at most so many heavy groups.
HEAVY = 10_000
#: So many rows that repeat an id and a text are unfolded at a time.
UNFOLD = 4096

Digest = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    """Every run of white space as one space. Only texts that have two blanks in a row then need a regular expression."""
    out = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(blank), F.lit(" "))
    return F.when(F.contains(out, F.lit("  ")), F.regexp_replace(out, "  +", " ")).otherwise(out)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def combined(df: DataFrame, ident: str, text: str, digest: Digest) -> DataFrame:
    """``d, t, keep, n``: each distinct text with its digest, least id and number of rows."""
    rows = df.select(F.col(f"`{ident}`").alias("i"), normalised(F.col(f"`{text}`")).alias("t"), F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"))
    merged = rows.withColumn("d", digest(F.col("t"))).groupBy("salt", "d", "t").agg(F.min("i").alias("keep"), F.count("*").alias("n"))
    return merged.groupBy("d", "t").agg(F.min("keep").alias("keep"), F.sum("n").alias("n"))


def winners(df: DataFrame, ident: str = "doc_id", text: str = "text", digest: Digest = sha256) -> tuple[DataFrame, bool]:
    """The written table ``d, keep, n``, and whether digests tell texts apart; if they don't, it has the texts ``t`` too."""
    found = combined(df, ident, text, digest)
    slim = settled(found.drop("t"), "winners")
    if slim.groupBy("d").count().filter("count > 1").isEmpty():
        return slim, True
    return settled(found, "winners"), False


def mark(df: DataFrame, ident: str = "doc_id", text: str = "text", digest: Digest = sha256) -> DataFrame:
    """One row per row of ``df``: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_digest`` (binary)."""
    table, apart = winners(df, ident, text, digest)
    keys = ["d"] if apart else ["d", "t"]
    total = table.agg(F.sum("n")).first()[0] or 0
    is_heavy = F.col("n") * HEAVY > F.lit(total)
    rows = df.select(F.col(f"`{ident}`").alias("i"), normalised(F.col(f"`{text}`")).alias("t")).withColumn("d", digest(F.col("t"))).groupBy(*keys, "i").agg(F.count("*").alias("times"))
    heavy = table.filter(is_heavy).select(*keys, F.col("keep").alias("heavy_keep"), F.col("n").alias("heavy_n"))
    # a heavy group's rows have their winner, and go to the next join under keys that spread them and that no digest can equal
    elsewhere = F.concat(F.lit(b"\x00"), F.col("d"), F.coalesce(F.col("i").cast("string"), F.lit("")).cast("binary"))
    rows = rows.join(F.broadcast(heavy), keys, "left").withColumn("key", F.when(F.col("heavy_n").isNull(), F.col("d")).otherwise(elsewhere))
    light = table.filter(~is_heavy).withColumnRenamed("d", "key").select("key", *keys[1:], "keep", "n")
    out = rows.join(light, ["key", *keys[1:]], "left").select("i", "d", "times", F.coalesce("n", "heavy_n").alias("group_size"), F.when(F.col("heavy_n").isNull(), F.col("keep")).otherwise(F.col("heavy_keep")).alias("keep_id"))
    # rows that repeat an id and a text, one by one again; the first of them may stay
    blocks = out.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(UNFOLD).cast("long"))))
    single = blocks.withColumn("k", F.explode(F.sequence(F.col("block"), F.least(F.col("times"), F.col("block") + UNFOLD) - 1)))
    return single.select(F.col("i").alias(ident), "keep_id", "group_size", (F.col("i").eqNullSafe(F.col("keep_id")) & (F.col("k") == 0)).alias("kept"), F.col("d").alias("text_digest"))


def keep_first(df: DataFrame, ident: str = "doc_id", text: str = "text", digest: Digest = sha256) -> DataFrame:
    """Of equal texts, the row with the least id, with its own columns."""
    table, apart = winners(df, ident, text, digest)
    t, d = unused(df.columns, "__t"), unused(df.columns, "__d")
    keys = [d] if apart else [d, t]
    least = table.select(F.col("d").alias("w_d"), F.col("keep").alias("w_keep"), *([] if apart else [F.col("t").alias("w_t")]))
    rows = df.withColumn(t, normalised(F.col(f"`{text}`"))).withColumn(d, digest(F.col(f"`{t}`")))
    match = (rows[d] == least.w_d) & rows[f"`{ident}`"].eqNullSafe(least.w_keep)
    if not apart:
        match &= rows[t] == least.w_t
    return rows.join(least, match, "left_semi").dropDuplicates(keys).drop(t, d)


def query(spark, sf_dir: str) -> DataFrame:
    found = mark(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("text_digest")).alias("text_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
