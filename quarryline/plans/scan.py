"""Positions and running aggregates per entity without a task per entity.

A window over an entity sorts all its rows in one task. Here the rows of an entity are cut into blocks, each block is
scanned by a task of its own, and a window over the blocks' totals carries what comes before. Blocks of positions hold a
bounded number of rows; blocks of time hold what a span of time holds, so choose the span by how dense the rows are
(for ordinals, by the number of rows wanted), and leave rows without a time out unless they are few: they are one block.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_MS = 3_600_000


def united(frames: Iterable[DataFrame]) -> DataFrame:
    """The rows of all frames, by name of column."""
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df)
    return first


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on equal keys, nulls equal to nulls: the columns of ``left``, then the others of ``right``.

    ``how`` is inner, left, left_semi or left_anti. No other column may be in both.
    """
    renamed = right.select(*[F.col(k).alias(f"_right_{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"_right_{i}"))
    return left.join(renamed, on, how).drop(*[f"_right_{i}" for i in range(len(keys))])


def with_position(df: DataFrame, keys: list[str], time_ms: str, ties: list[str], block_ms: int = HOUR_MS, name: str = "pos") -> DataFrame:
    """Adds ``name``: the row's place from 0 in its entity by (time, ties); null times come first.

    Blocks are spans of time. Of rows equal in keys, time and ties the order follows from a hash of all their columns, so
    that it is the same in every evaluation; rows equal in every column are interchangeable.
    """
    block = F.coalesce(F.floor(F.col(time_ms) / block_ms).cast("bigint"), F.lit(-(2**62)))
    rows = df.withColumn("_block", block)
    counts = rows.groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_block").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    on = F.col("_block") == F.col("_b")
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    inside = Window.partitionBy(*keys, "_block").orderBy(F.col(time_ms).asc_nulls_first(), *ties, F.xxhash64(*hashed))
    placed = rows.withColumn("_rank", F.row_number().over(inside)).join(shift, on)
    return placed.withColumn(name, (F.col("_shift") + F.col("_rank") - 1).cast("bigint")).drop("_block", "_b", "_shift", "_rank", *[f"_k{i}" for i in range(len(keys))])


def running(df: DataFrame, keys: list[str], pos: str, value: Column, how: str, name: str, block: int = 65_536, before: bool = False) -> DataFrame:
    """Adds ``name``: ``sum``, ``max`` or ``last`` (non-null) of ``value`` over the rows of the entity up to this one.

    ``pos`` orders the rows (see ``with_position``). With ``before`` the row itself is left out.
    """
    rows = df.withColumn("_v", value).withColumn("_c", F.floor(F.col(pos) / block).cast("bigint"))
    fold = {"sum": F.sum("_v"), "max": F.max("_v"), "last": F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(pos)))}[how]
    totals = rows.groupBy(*keys, "_c").agg(fold.alias("_t"))
    earlier = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    over = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}[how]
    carried = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_c").alias("_b"), over("_t").over(earlier).alias("_carry"))
    on = F.col("_c") == F.col("_b")
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*keys, "_c").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    local = over("_v").over(inside)
    joined = rows.withColumn("_l", local).join(carried, on)
    result = {"sum": F.coalesce("_l", F.lit(0)) + F.coalesce("_carry", F.lit(0)), "max": F.greatest("_l", "_carry"), "last": F.coalesce("_l", "_carry")}[how]
    return joined.withColumn(name, result).drop("_v", "_c", "_b", "_l", "_carry", *[f"_k{i}" for i in range(len(keys))])


def neighbours(df: DataFrame, keys: list[str], pos: str, columns: list[str], offsets: dict[str, int], block: int = 65_536) -> DataFrame:
    """Adds, for each ``prefix: by`` of the offsets, the columns of the row ``by`` places before (negative: after) as ``prefix + column``, null where there is none.

    ``pos`` numbers the rows of an entity without holes (see ``with_position``). Rows are sorted once, in blocks; those at the edges of a
    block also go to the block beside it, so nothing is joined and the plan of ``df`` is evaluated once.
    """
    reach = max(map(abs, offsets.values()))
    if not 0 < reach <= block // 2:
        raise ValueError("offsets must lie within half a block")
    own, at = F.floor(F.col(pos) / block), F.pmod(F.col(pos), F.lit(block))
    places = F.array_compact(F.array(own, F.when(at < reach, own - 1), F.when(at >= block - reach, own + 1)))
    rows = df.withColumn("_home", own).withColumn("_b", F.explode(places))
    by = Window.partitionBy(*keys, "_b").orderBy(pos)
    added = {f"{prefix}{c}": F.lag(c, n).over(by) if n > 0 else F.lead(c, -n).over(by) for prefix, n in offsets.items() for c in columns}
    return rows.withColumns(added).where("_b = _home").drop("_b", "_home")


def shifted(df: DataFrame, keys: list[str], pos: str, columns: list[str], by: int, prefix: str) -> DataFrame:
    """``neighbours`` for one offset."""
    return neighbours(df, keys, pos, columns, {prefix: by})
