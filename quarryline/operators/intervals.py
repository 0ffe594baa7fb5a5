"""Covered periods and gaps of time intervals per entity.

The aggregate is a sorted list of disjoint intervals. It is mergeable: two lists combine by one linear merge, and the
result does not depend on the order of merging. Every scan task folds its rows into lists (map side), a reduction tree
merges the lists, and lists and complements are read off at the end.

A list is kept per entity and *block* of time, an interval belonging to the block its start falls into. A block of
``block_ms`` holds at most that many disjoint intervals, however many rows the entity has, so no state grows with the
data. What reaches from one block into later ones is one number, the latest end so far. It is carried in two steps: by a
window over the blocks of one *stretch* (``STRETCH`` blocks), and by a window over the stretches' own ends, a number each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scan import null_safe_join
from ..plans.staging import staged

HOUR_MS, STRETCH = 3_600_000, 256
_LISTS = "start_ms array<bigint>, end_ms array<bigint>"


def merge_lists(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of two sorted lists of disjoint intervals, itself sorted and disjoint. Touching intervals join."""
    place = np.searchsorted(starts_a, starts_b, side="right") + np.arange(len(starts_b))
    n = len(starts_a) + len(starts_b)
    from_a = np.ones(n, dtype=bool)
    from_a[place] = False
    starts, ends = np.empty(n, np.int64), np.empty(n, np.int64)
    starts[from_a], ends[from_a] = starts_a, ends_a
    starts[place], ends[place] = starts_b, ends_b
    return _joined(starts, ends)


def _joined(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    reach = np.maximum.accumulate(ends)
    opens = np.ones(len(starts), dtype=bool)
    opens[1:] = starts[1:] > reach[:-1]
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], reach[last]


def _fold(keys: list[str], block_ms: int, rows: int):
    """Lists of the rows of a task; at most ``rows`` rows are held at a time."""

    def flush(batches: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        held = pa.Table.from_batches(batches)
        frame = held.select([*keys, "start_ms", "end_ms"]).to_pandas()
        frame["block"] = frame["start_ms"] // block_ms
        code = frame.groupby([*keys, "block"], sort=True, dropna=False).ngroup().to_numpy()
        order = np.lexsort((frame["start_ms"].to_numpy(), code))
        code, frame = code[order], frame.iloc[order]
        starts = frame["start_ms"].to_numpy()
        reach = frame["end_ms"].groupby(code).cummax().to_numpy()
        opens = np.ones(len(frame), dtype=bool)
        opens[1:] = (code[1:] != code[:-1]) | (starts[1:] > reach[:-1])
        first = np.flatnonzero(opens)
        ends = reach[np.append(first[1:], len(frame)) - 1]
        lists = np.flatnonzero(np.append(True, code[first][1:] != code[first][:-1]))
        offsets = pa.array(np.append(lists, len(first)), pa.int32())
        head = frame.iloc[first[lists]]
        columns = [pa.array(head[k], type=held.schema.field(k).type, from_pandas=True) for k in keys]
        columns += [pa.array(head["block"].to_numpy()), pa.array(np.full(len(head), number, np.int64))]
        columns += [pa.ListArray.from_arrays(offsets, pa.array(starts[first])), pa.ListArray.from_arrays(offsets, pa.array(ends))]
        return pa.RecordBatch.from_arrays(columns, names=[*keys, "block", "slot", "start_ms", "end_ms"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        slot = context.partitionId() if context else 0
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= rows:
                yield flush(held, slot)
                held, size = [], 0
        if held:
            yield flush(held, slot)

    return run


def _merge(keys: list[str]):
    """Merges consecutive lists of equal keys; the input is sorted by keys. Holds one list at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, starts, ends, types = None, None, None, None
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            columns = [pa.array([o[0][i] for o in out], type=types[i]) for i in range(len(keys))]
            offsets = pa.array(np.append(0, np.cumsum([len(o[1]) for o in out])), pa.int32())
            columns += [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([o[j] for o in out]))) for j in (1, 2)]
            return pa.RecordBatch.from_arrays(columns, names=[*keys, "start_ms", "end_ms"])

        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            names = list(zip(*[batch.column(k).to_pylist() for k in keys]))
            s, e = batch.column("start_ms"), batch.column("end_ms")
            bounds = s.offsets.to_numpy()
            base = bounds[0]
            s, e = s.flatten().to_numpy(), e.flatten().to_numpy()
            for i, name in enumerate(names):
                lo, hi = bounds[i] - base, bounds[i + 1] - base
                if name == key:
                    starts, ends = merge_lists(starts, ends, s[lo:hi], e[lo:hi])
                    continue
                if key is not None:
                    out.append((key, starts, ends))
                key, starts, ends = name, s[lo:hi], e[lo:hi]
            if len(out) > 2000:
                yield emit()
                out = []
        if key is not None:
            out.append((key, starts, ends))
        if out:
            yield emit()

    return run


def interval_lists(df: DataFrame, keys: list[str], start: str, end: str, block_ms: int = HOUR_MS, fan_in: int = 16, task_rows: int = 131_072) -> DataFrame:
    """The merged aggregate: ``keys, block, start_ms, end_ms`` with sorted lists of disjoint intervals.

    ``start`` and ``end`` are BIGINT milliseconds. Rows with a null time or ``end <= start`` cover nothing. Null keys are
    a key of their own. Repeated rows change nothing. An empty input gives no rows.
    """
    rows = df.select(*keys, F.col(start).alias("start_ms"), F.col(end).alias("end_ms")).where("end_ms > start_ms")
    typed = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    lists = rows.mapInArrow(_fold(keys, block_ms, task_rows), f"{typed}, block bigint, slot bigint, {_LISTS}")
    tasks = rows.rdd.getNumPartitions()
    width = fan_in
    while width < tasks:  # inner levels of the tree, each merging the lists of fan_in tasks
        inner = [*keys, "block", "slot"]
        lists = lists.withColumn("slot", F.floor(F.col("slot") / width).cast("bigint"))
        lists = lists.repartition(*inner).sortWithinPartitions(*inner).mapInArrow(_merge(inner), f"{typed}, block bigint, slot bigint, {_LISTS}")
        width *= fan_in
    outer = [*keys, "block"]
    return lists.drop("slot").repartition(*outer).sortWithinPartitions(*outer).mapInArrow(_merge(outer), f"{typed}, block bigint, {_LISTS}")


def _openings(lists: DataFrame, keys: list[str]) -> DataFrame:
    """Per block: ``opens``, the intervals that no earlier one reaches, each with the end of the coverage before it; ``last_end``; ``stretch``."""
    lists = staged(lists.withColumn("stretch", F.floor(F.col("block") / STRETCH)).withColumn("last_end", F.element_at("end_ms", -1)), "lists")
    before = lambda *of: Window.partitionBy(*of).rowsBetween(Window.unboundedPreceding, -1)
    ends = lists.groupBy(*keys, "stretch").agg(F.max("last_end").alias("reach"))
    ends = ends.withColumn("reach", F.max("reach").over(before(*keys).orderBy("stretch")))
    carried = null_safe_join(lists, ends, [*keys, "stretch"])
    carried = carried.withColumn("carry", F.greatest("reach", F.max("last_end").over(before(*keys, "stretch").orderBy("block"))))
    opens = F.expr(
        """filter(transform(start_ms, (s, i) -> struct(s AS start_ms,
             if(i = 0, carry, greatest(carry, end_ms[greatest(i - 1, 0)])) AS before_ms)),
           x -> x.before_ms IS NULL OR x.start_ms > x.before_ms)"""
    )
    return carried.select(*keys, "stretch", "block", "last_end", opens.alias("opens"))


def gaps(df: DataFrame, keys: list[str], start: str, end: str, **options: int) -> DataFrame:
    """``keys, gap_start_ms, gap_end_ms``: the holes between the covered periods of each entity."""
    opens = _openings(interval_lists(df, keys, start, end, **options), keys)
    rows = opens.select(*keys, F.explode("opens").alias("o")).where("o.before_ms IS NOT NULL")
    return rows.select(*keys, F.col("o.before_ms").alias("gap_start_ms"), F.col("o.start_ms").alias("gap_end_ms"))


def covered_periods(df: DataFrame, keys: list[str], start: str, end: str, **options: int) -> DataFrame:
    """``keys, period_start_ms, period_end_ms``: the continuous covered periods of each entity.

    A period ends where the coverage before the next opening does, or at the entity's last end.
    """
    opens = staged(_openings(interval_lists(df, keys, start, end, **options), keys), "openings").withColumn("next_of", F.expr("try_element_at(opens, 1).before_ms"))
    after = lambda *of: Window.partitionBy(*of).rowsBetween(1, Window.unboundedFollowing)
    stretches = opens.groupBy(*keys, "stretch").agg(F.min("next_of").alias("next_of"), F.max("last_end").alias("last_end"))
    # Ends before openings grow with time, so the first is the least.
    later = F.min("next_of").over(after(*keys).orderBy("stretch"))
    stretches = stretches.select(*keys, "stretch", F.coalesce(later, F.max("last_end").over(Window.partitionBy(*keys))).alias("beyond"))
    closed = null_safe_join(opens, stretches, [*keys, "stretch"])
    closed = closed.withColumn("next_before", F.coalesce(F.min("next_of").over(after(*keys, "stretch").orderBy("block")), "beyond"))
    periods = F.expr(
        """transform(opens, (o, i) -> struct(o.start_ms AS period_start_ms,
             if(i + 1 < size(opens), opens[least(i + 1, size(opens) - 1)].before_ms, next_before) AS period_end_ms))"""
    )
    return closed.select(*keys, F.explode(periods).alias("p")).select(*keys, "p.*")
