"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, directory: str, name: str, *columns: str) -> DataFrame:
    """Table ``name`` of ``directory``; with ``columns`` only those reach the scan."""
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return df.select(*columns) if columns else df


def millis(column: Column | str) -> Column:
    """Whole milliseconds of a DOUBLE in seconds; null for null, NaN, infinite and out-of-range values."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(F.abs(column) < F.lit(9.0e12), F.round(column * 1000.0)).otherwise(None).try_cast("bigint")


def first_rows(df: DataFrame, keys: list[str], payload: list[str], arrival: str = "ingested_at") -> DataFrame:
    """One row per key: the payload of the delivery that arrived first (nulls last).

    Deliveries that arrived at the same moment are told apart by their payload, so the result does not
    depend on the order of rows. Null keys form a key of their own.
    """
    order = F.struct(F.col(arrival).isNull().alias("n"), F.col(arrival).alias("t"), *[F.col(c) for c in payload])
    kept = df.groupBy(*keys).agg(F.min(order).alias("_first"))
    return kept.select(*keys, *[F.col("_first")[c].alias(c) for c in payload], F.col("_first.t").alias(arrival))
