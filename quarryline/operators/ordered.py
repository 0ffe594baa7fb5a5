"""Ordered operators: sessions, sliding and tumbling windows, sequential folds, each split where it may be cut."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.grouped import fold_groups
from ..plans.scan import null_safe_join, running, shifted, with_position
from ..plans.staging import staged


def gap_sessions(df: DataFrame, keys: list[str], start: str, end: str, ties: list[str], gap_ms: int, name: str = "session") -> DataFrame:
    """Adds the number, from 0, of the session of a row: a new one opens where a row starts ``gap_ms`` or more after the end of all before it.

    Rows with a null time belong to the first session. No task holds an entity.
    """
    placed = with_position(df, keys, start, ties, name="_pos")
    reach = running(placed, keys, "_pos", F.col(end), "max", "_reach", before=True)
    opens = F.when(F.col(start) - F.col("_reach") >= gap_ms, 1).otherwise(0)
    return running(reach, keys, "_pos", opens, "sum", name).drop("_reach", "_pos")


def count_batches(df: DataFrame, keys: list[str], time: str, ties: list[str], size: int, stride: int) -> DataFrame:
    """Rows repeated for each batch they belong to: ``batch`` b has ``size`` rows from place ``b * stride``, until one reaches the end."""
    placed = with_position(df, keys, time, ties, name="_pos")
    rows = null_safe_join(placed, df.groupBy(*keys).agg(F.count("*").alias("_n")), keys)
    last = F.greatest(F.lit(0), F.ceil((F.col("_n") - size) / stride)).cast("bigint")
    first = F.greatest(F.lit(0), F.floor((F.col("_pos") - size) / stride) + 1).cast("bigint")
    rows = rows.withColumn("_to", F.least(last, F.floor(F.col("_pos") / stride).cast("bigint"))).withColumn("_from", first)
    return rows.where("_from <= _to").withColumn("batch", F.explode(F.sequence("_from", "_to"))).drop("_n", "_pos", "_from", "_to")


def forward_fill(df: DataFrame, keys: list[str], time: str, ties: list[str], boundary: Column, name: str = "run") -> DataFrame:
    """Adds the number of boundary rows so far, so rows between boundaries share it; 0 before the first."""
    placed = with_position(df, keys, time, ties, name="_pos")
    return running(placed, keys, "_pos", F.when(boundary, 1).otherwise(0), "sum", name).drop("_pos")


def fold_islands(df: DataFrame, keys: list[str], start: str, end: str, ties: list[str], cut_ms: int, fold: Callable[[list[dict], bool], list[dict]], schema: str) -> DataFrame:
    """A sequential fold per entity, run apart on each stretch that no row bridges.

    A fold whose step never looks across ``cut_ms`` without rows gives the same on stretches between such gaps, so
    the tasks get stretches, not entities. ``fold`` gets the rows of one stretch in order, and whether it is the last.
    """
    split = staged(gap_sessions(df, keys, start, end, ties, cut_ms, "_stretch"), "stretches")
    split = null_safe_join(split, split.groupBy(*keys).agg(F.max("_stretch").alias("_end")), keys)
    return fold_groups(split, [*keys, "_stretch"], [start, *ties], lambda rows: fold(rows, rows[0]["_stretch"] == rows[0]["_end"]), schema)


def window_step(start: str, end: str, target: int, overlap: int):
    """Runs of ``plans.chains``: windows as long as ``target`` allows; the next begins at the first later row that ends within ``overlap`` of
    the end of the window, and at least one row on; the one with the last row is the last."""
    if not 0 <= overlap < target:
        raise ValueError("the overlap must be less than the target")

    def step(values: dict[str, list], first: int, more: bool) -> tuple[int | None, int] | None:
        starts, ends = values[start], values[end]
        last, n = first, len(starts)
        while last + 1 < n and ends[last + 1] - starts[first] <= target:
            last += 1
        if last + 1 == n:
            return None if more else (None, last)
        return next((i for i in range(first + 1, last + 1) if ends[i] > ends[last] - overlap), last + 1), last

    return step


def passage_step(start: str, end: str, closes: str, gap: int, target: int):
    """Runs of ``plans.chains``: a new passage after a gap of at least ``gap``, when it has lasted ``target`` and the row before closes a
    sentence, and after the row with which it has lasted 1.5 times the target."""

    def step(values: dict[str, list], first: int, more: bool) -> tuple[int | None, int] | None:
        starts, ends, closed = values[start], values[end], values[closes]
        for i in range(first + 1, len(starts)):
            lasted = ends[i - 1] - starts[first]
            if starts[i] - ends[i - 1] >= gap or lasted >= target and closed[i - 1] or 2 * lasted >= 3 * target:
                return i, i - 1
        return None if more else (None, len(starts) - 1)

    return step


def speech_step(start: str, end: str, most: int, gap: int):
    """Runs of ``plans.chains``: intervals joined while the pause is at most ``gap`` and the whole at most ``most``."""

    def step(values: dict[str, list], first: int, more: bool) -> tuple[int | None, int] | None:
        starts, ends = values[start], values[end]
        reach = ends[first]
        for i in range(first + 1, len(starts)):
            if starts[i] - reach > gap or max(ends[i], reach) - starts[first] > most:
                return i, i - 1
            reach = max(reach, ends[i])
        return None if more else (None, len(starts) - 1)

    return step


def all_runs(values: dict[str, list], step) -> list[tuple[int, int]]:
    """``(first, last)`` of the runs of whole columns, one after another."""
    out, at = [], 0 if next(iter(values.values())) else None
    while at is not None:
        following, last = step(values, at, False)
        out.append((at, last))
        at = following
    return out


def piece_starts(start: Column, end: Column, most: int, least: int = 50) -> Column:
    """Where the pieces of an interval begin, see ``pieces``."""
    begins = F.sequence(start, end - 1, F.lit(most).cast("bigint"))
    return F.filter(begins, lambda x: (end - x > least) | (x == start))


def pieces(start: int, end: int, most: int, least: int = 50) -> list[tuple[int, int]]:
    """An interval in pieces of ``most``; a last piece of ``least`` or less is left out unless it is the only one."""
    cuts = [(a, min(a + most, end)) for a in range(start, end, most)]
    return cuts[:-1] if len(cuts) > 1 and cuts[-1][1] - cuts[-1][0] <= least else cuts


__all__ = ["all_runs", "pieces", "passage_step", "speech_step", "window_step", "count_batches", "fold_islands", "forward_fill", "gap_sessions", "running", "shifted", "with_position"]
