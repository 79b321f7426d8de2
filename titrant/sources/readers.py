"""Scans: JSON documents, YAML lists, all-text CSV, article XML, plain-text sheets."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import csv_cell
from ..schemas import MANIFEST


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)\z", 1), r"\.[^.]*\z", "")


def json_documents(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """One document a file, with ``key`` from the file's name: the number inside may differ from it."""
    body = T.StructType([f for f in schema if f.name != "key"])
    return spark.read.schema(body).option("multiLine", True).json(folder).withColumn("key", stem(F.col("_metadata.file_name")))


def raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``key, doc VARIANT``: where properties may be bare or sourced."""
    text = spark.read.text(folder, wholetext=True)
    return text.select(stem(F.col("_metadata.file_name")).alias("key"), F.parse_json("value").alias("doc"))


def yaml_rows(path: str) -> list[dict]:
    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or []


def yaml_table(spark: SparkSession, path: str, schema: T.StructType, key: str | None = None) -> DataFrame:
    """A list of mappings as a table; of entries with one ``key``, the last. For files that people edit: they are small."""
    rows = yaml_rows(path)
    if key:
        rows = list({r[key]: r for r in rows}.values())
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def csv_text(spark: SparkSession, path: str, columns: Sequence[str], missing_as_blank: bool = True) -> DataFrame:
    """All columns as text. Cells that mean "missing" become empty, or stay as written."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    out = spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', multiLine=True)
    return out.select(*[(csv_cell(F.col(c)) if missing_as_blank else F.coalesce(c, F.lit(""))).alias(c) for c in columns])


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The papers' manifest; an absent file is an empty one."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], MANIFEST)
    return csv_text(spark, path, MANIFEST.names, missing_as_blank=False)


def xml_papers(spark: SparkSession, folder: str) -> DataFrame:
    """``pmcid, xml``: the raw bytes of each file."""
    return spark.read.format("binaryFile").load(folder).select(stem(F.col("path")).alias("pmcid"), F.col("content").alias("xml"))


def sheet_texts(spark: SparkSession, folder: str) -> DataFrame:
    """``key, text``: sheets whose text was extracted before. Spark's scans pass over files without a byte, so a sheet without text needs a blank in its file."""
    return spark.read.text(folder, wholetext=True).select(stem(F.col("_metadata.file_name")).alias("key"), F.coalesce("value", F.lit("")).alias("text"))
