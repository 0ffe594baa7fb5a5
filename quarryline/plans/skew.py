"""Joins whose left side may hold a third of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import null_safe_join


def split_hot_join(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = 500_000, how: str = "left", counted: DataFrame | None = None) -> DataFrame:
    """``left`` joined to ``right`` on equal keys, nulls equal to nulls; the columns of ``left``, then the others of ``right``.

    Keys with more than ``hot_rows`` left rows, or one in 10,000 of all if that is more, are hot; there are at most 10,000.
    Their left rows are spread over salts, and only their right rows are repeated for each salt, so no task gets more than about that many rows of a
    key. ``counted`` is what the rows per key are counted on, if that is cheaper to read than ``left`` and has no fewer of a key.
    Without hot keys the join stays plain.
    """
    counted = left if counted is None else counted
    rows = counted.count()
    hot: list = []
    if rows > hot_rows:
        most = max(hot_rows, rows // 10_000)
        counts = counted.groupBy(*keys).count().where(F.col("count") > most)
        hot = counts.withColumn("_salts", F.ceil(F.col("count") / most).cast("int")).drop("count").collect()
    if not hot:
        return null_safe_join(left, right, keys, how)
    few = F.broadcast(left.sparkSession.createDataFrame(hot, left.select(*keys, F.lit(0).alias("_salts")).schema))
    salts = F.coalesce("_salts", F.lit(1))
    spread = null_safe_join(left, few, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), salts).cast("int")).drop("_salts")
    copies = null_safe_join(right, few, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return null_safe_join(spread, copies, [*keys, "_salt"], how).drop("_salt")
