"""Session defaults: UTC, adaptive execution, skew handling."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the session is the caller's."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("quarryline").config("spark.driver.memory", memory)
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(partitions), **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
