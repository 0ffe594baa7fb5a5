"""Texts from folders, in pieces, and what a file is known by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path, size, modified`` of the files below a folder, without their content."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return rows.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def literature(spark: SparkSession, folder: str, piece_chars: int, pattern: str = "*.{txt,md,tex}") -> DataFrame:
    """``path, piece_no, text``: files with white space collapsed, in pieces of ``piece_chars``; blank files give none."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(folder, wholetext=True)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.trim(F.regexp_replace("value", r"\s+", " ")).alias("t")).where("t <> ''")
    rows = rows.withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.floor((F.length("t") - 1) / piece_chars).cast("int"))))
    return rows.select("path", "piece_no", F.expr(f"substring(t, piece_no * {piece_chars} + 1, {piece_chars})").alias("text"))


def artifacts(spark: SparkSession, folder: str, schema: str, whole: bool = True) -> DataFrame:
    """JSON artifacts below a folder by a declared schema, a file each or, unless ``whole``, a line each; those that do not parse give rows of nulls in ``_corrupt``'s company and are left out."""
    rows = spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", "true").option("multiLine", whole).json(folder)
    return rows.where("_corrupt IS NULL").drop("_corrupt")


def united_artifacts(spark: SparkSession, folder: str, schema: str, keys: list[str], value: str) -> DataFrame:
    """``keys, <value>s``: the distinct values, sorted, of all artifacts, a line each, below a folder that have the keys; nulls are left out."""
    rows = artifacts(spark, folder, schema, whole=False)
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias(f"{value}s"))
