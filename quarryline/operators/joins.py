"""Joins on time: overlap, as-of, and neighbours by place. No task ever holds a whole entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scan import running, with_position


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], bucket_ms: int = 600_000) -> DataFrame:
    """Pairs of rows with equal keys whose closed intervals ``[s, e]`` and ``[rs, re]`` touch.

    Both sides are repeated for each bucket of time they touch and joined on keys and bucket; a pair is kept only
    in the first bucket that both touch, so it comes once. Null or reversed intervals match nothing. Choose
    the bucket near the usual length of an interval. Columns other than keys must differ in name.
    """

    def spread(df: DataFrame, s: str, e: str) -> DataFrame:
        first, last = F.floor(F.col(s) / bucket_ms), F.floor(F.col(e) / bucket_ms)
        return df.where(F.col(s) <= F.col(e)).withColumn("_b", F.explode(F.sequence(first, last)))

    joined = spread(left, "s", "e").join(spread(right, "rs", "re"), [*keys, "_b"])
    first = F.floor(F.greatest("s", "rs") / bucket_ms)
    return joined.where((F.col("s") <= F.col("re")) & (F.col("rs") <= F.col("e")) & (F.col("_b") == first)).drop("_b")


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, value: str, name: str) -> DataFrame:
    """``left`` with ``name``: the ``value`` of the last right row of the entity at or before the left row's time.

    Of right rows at one time the one with the largest value counts. Left rows with a null time, and those before the
    first right row, get null. Both sides are placed together by time and the last value is carried block by block.
    """
    columns = left.columns
    marks = right.where(F.col(right_at).isNotNull()).groupBy(*keys, F.col(right_at).alias("_at")).agg(F.max(value).alias("_value"))
    rows = left.withColumns({"_at": F.col(at), "_value": F.lit(None).cast(right.schema[value].dataType), "_side": F.lit(1)})
    both = rows.unionByName(marks.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    placed = with_position(both, keys, "_at", ["_side"], name="_place")
    carried = running(placed, keys, "_place", F.col("_value"), "last", "_last")
    return carried.where("_side = 1").select(*columns, F.when(F.col("_at").isNotNull(), F.col("_last")).alias(name))


def nearest_time(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, value: str, name: str) -> DataFrame:
    """``left`` with ``name``: the ``value`` of the right row of the entity nearest in time; the smaller value on a tie.

    Two as-of joins, one in each direction of time, instead of all pairs of an entity.
    """
    columns = left.columns
    one = lambda sign: right.select(*keys, (sign * F.col(right_at)).alias("_t"), F.struct((sign * F.col(right_at)).alias("t"), F.col(value).alias("v")).alias("_pick"))
    back = asof_join(left.withColumn("_now", F.col(at)), one(1).groupBy(*keys, "_t").agg(F.min("_pick").alias("_pick")), keys, "_now", "_t", "_pick", "_before")
    both = asof_join(back.withColumn("_now", -F.col(at)), one(-1).groupBy(*keys, "_t").agg(F.min("_pick").alias("_pick")), keys, "_now", "_t", "_pick", "_after")
    before, after = F.abs(F.col("_before.t") - F.col(at)), F.abs(-F.col("_after.t") - F.col(at))
    tie = F.least("_before.v", "_after.v")
    best = F.when(before < after, F.col("_before.v")).when(after < before, F.col("_after.v")).when(before == after, tie).otherwise(F.coalesce("_before.v", "_after.v"))
    return both.select(*columns, best.alias(name))
