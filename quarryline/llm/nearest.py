"""Matching records by nearest time within an entity.

Both tables are range-partitioned together by (entity, time) and sorted, so an entity of any size is spread over as
many tasks as it needs. One scan of each partition gives every left record the right records before and after it that
the partition holds, and the partition's first and last right record. Those edges, two per task, are exchanged by a
prefix scan over the partitions in key order, which completes the records near the edges. The large side is shuffled
once and never stored; what is written between the two passes are the left records and the edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import staged

_SCAN = "part int, edge boolean, entity string, at bigint, left_id string, prev_entity string, prev_at bigint, prev_id string, next_entity string, next_at bigint, next_id string"
_FIELDS = [f.split()[0] for f in _SCAN.split(", ")]
_TYPES = [pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
_NONE = (None, None, None)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (entity, at, side, id) with side 0 for right records; holds left rows until the next right one."""
    from pyspark import TaskContext

    context = TaskContext.get()
    part = context.partitionId() if context else 0
    last = first = _NONE  # right records: the latest so far, and the partition's first
    waiting: list[list[pa.Array]] = []  # columns of left rows that no right record has followed yet
    seen = False

    def finished(columns: list[pa.Array], after: tuple) -> pa.RecordBatch:
        n = len(columns[0])
        return _batch([*columns, *(pa.nulls(n, t) if v is None else pa.array([v] * n, t) for v, t in zip(after, _TYPES[8:]))])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        seen = True
        entity, ids = batch.column("entity"), batch.column("id")
        at, side = batch.column("at").to_numpy(), batch.column("side").to_numpy()
        changed = np.ones(n, dtype=bool)
        if n > 1:
            changed[1:] = pc.not_equal(entity[1:], entity[:-1]).to_numpy(zero_copy_only=False)
        right = side == 0
        # Of right records with equal entity and time only the first counts: the smallest id.
        again = np.zeros(n, dtype=bool)
        again[1:] = right[1:] & right[:-1] & ~changed[1:] & (at[1:] == at[:-1])
        if right[0] and last[0] == entity[0].as_py() and last[1] == at[0]:
            stop = int(np.argmin(right & (at == at[0]) & (np.cumsum(changed) == 1))) or n
            again[:stop] = True
        right &= ~again
        place = np.where(right, np.arange(n), -1)
        before = np.maximum.accumulate(place)
        place[~right] = n
        after = np.minimum.accumulate(place[::-1])[::-1]
        rights = np.flatnonzero(right)

        def record(i: int) -> tuple:
            return entity[i].as_py(), int(at[i]), ids[i].as_py()

        if len(rights):
            head = record(int(rights[0]))
            for columns in waiting:
                yield finished(columns, head)
            waiting = []
            if first is _NONE:
                first = head
        left = np.flatnonzero(side == 1)
        if len(left):
            rows = pa.array(left)
            b, a = (pa.array(x[left], mask=~((x[left] >= 0) & (x[left] < n))) for x in (before, after))
            columns = [pa.array(np.full(len(left), part, np.int32)), pa.array(np.zeros(len(left), dtype=bool))]
            columns += [c.take(rows) for c in (entity, batch.column("at"), ids)]
            for c, carried in zip((entity, batch.column("at"), ids), last):
                taken = c.take(b)
                columns.append(taken if carried is None else taken.fill_null(carried))
            open_ = np.asarray(a.is_null())
            done = [c.filter(pa.array(~open_)) for c in columns]
            if len(done[0]):
                yield _batch([*done, *(c.take(a.drop_null()) for c in (entity, batch.column("at"), ids))])
            if open_.any():
                waiting.append([c.filter(pa.array(open_)) for c in columns])
        if len(rights):
            last = record(int(rights[-1]))
    for columns in waiting:
        yield finished(columns, _NONE)
    if seen:
        yield _batch([pa.array([v], t) for v, t in zip((part, True, None, None, None, *last, *first), _TYPES)])


def _batch(columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, _TYPES)], names=_FIELDS)


def nearest(left: DataFrame, right: DataFrame, tolerance: int) -> DataFrame:
    """Each left record with the right record of its entity that is nearest in time, at most ``tolerance`` away.

    Both have ``entity STRING, at BIGINT, id STRING``; other columns are not looked at. The result is one row per row of ``left`` with
    a non-null entity and time: ``entity, at, left_id, match_id, match_at``, both null where nothing is near enough.
    Right records with a null entity or time take no part. Of two equally near ones the earlier is taken, of several
    at that time the one with the smallest id; a null id counts as the empty text. Repeated right rows change nothing.
    """
    sides = [df.where("entity IS NOT NULL AND at IS NOT NULL").select("entity", "at", F.lit(s).cast("tinyint").alias("side"), F.coalesce("id", F.lit("")).alias("id")) for s, df in enumerate((right, left))]
    rows = sides[0].unionByName(sides[1]).repartitionByRange("entity", "at").sortWithinPartitions("entity", "at", "side", "id")
    scanned = staged(rows.mapInArrow(_scan, _SCAN), "nearest")
    edges = scanned.where("edge").select("part", F.struct("prev_entity", "prev_at", "prev_id").alias("last"), F.struct("next_entity", "next_at", "next_id").alias("first"))
    # A row per task, so one task may scan them. A part without right records passes its neighbours' edges on.
    back, on = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("part").rowsBetween(1, Window.unboundedFollowing)
    held = lambda c, x: F.when(F.col(f"{c}.{x}").isNotNull(), F.col(c))
    carried = edges.select("part", F.last(held("last", "prev_at"), ignorenulls=True).over(back).alias("carry_prev"), F.first(held("first", "next_at"), ignorenulls=True).over(on).alias("carry_next"))
    whole = scanned.where("NOT edge").join(F.broadcast(carried), "part", "left")
    sides = {}
    for side in ("prev", "next"):
        own, carry = F.struct(f"{side}_entity", f"{side}_at", f"{side}_id"), F.col(f"carry_{side}")
        one = F.when(F.col(f"{side}_at").isNotNull(), own).otherwise(carry)
        one = F.when(one[f"{side}_entity"] == F.col("entity"), one)
        sides[side] = (F.abs(one[f"{side}_at"] - F.col("at")), one)
        whole = whole.withColumn(f"{side}_far", sides[side][0]).withColumn(f"{side}_one", one)
    far = F.least("prev_far", "next_far")
    best = F.when(F.col("prev_far") == far, F.struct(F.col("prev_one.prev_id").alias("id"), F.col("prev_one.prev_at").alias("at"))).otherwise(F.struct(F.col("next_one.next_id").alias("id"), F.col("next_one.next_at").alias("at")))
    near = F.when(far <= tolerance, best)
    return whole.select("entity", "at", "left_id", near["id"].alias("match_id"), near["at"].alias("match_at"))
