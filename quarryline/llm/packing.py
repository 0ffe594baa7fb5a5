"""Filling fixed-capacity containers with items of varying length.

Shortest-pack-first over the length histogram: the items of a group are counted by length, lengths are placed from the
longest to the shortest, and each goes to the pack that is filled least. Equal packs are one *pattern* with a count, so
the work depends on the number of different lengths (at most the capacity), not of items. The patterns are then joined
back to the items by rank: the r-th item of a length takes the r-th place that the patterns have for that length.

Ranks of a length are assigned per salt (a hash of the item) and shifted by the number of items in the salts before, so
that a group holding a third of all items is ranked by many tasks. The number of salts follows the largest count in the
histogram. Places are numbered the same way and join one to one, so the join has no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import staged

PACKED, OVERSIZED = "packed", "oversized"


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(packs, [(length, times), ...])`` for ``{length: items}``; every length is 1 to ``capacity``.

    Lengths go from the longest to the shortest, each item to the pack with the most free space that exists, or a
    new pack if even that one is too full. Of packs with equal free space, the pattern opened first is taken first.
    """
    by_space: dict[int, list[list]] = {}  # free space to [packs, pattern], oldest first
    most = -1  # no pack has more free space

    def put(space: int, packs: int, pattern: tuple[tuple[int, int], ...]) -> None:
        nonlocal most
        by_space.setdefault(space, []).append([packs, pattern])
        most = max(most, space)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while most >= length and not by_space.get(most):
                most -= 1
            if most < length:  # every pack is too full: new ones, each the emptiest until it is full
                each = capacity // length
                packs, rest = divmod(left, each)
                if packs:
                    put(capacity - each * length, packs, ((length, each),))
                if rest:
                    put(capacity - rest * length, 1, ((length, rest),))
                break
            oldest = by_space[most][0]
            packs, pattern = min(oldest[0], left), oldest[1]
            oldest[0] -= packs
            if not oldest[0]:
                by_space[most].pop(0)
            left -= packs
            last, times = pattern[-1]
            put(most - length, packs, (*pattern[:-1], (last, times + 1)) if last == length else (*pattern, (length, 1)))
    return [(packs, list(pattern)) for space in sorted(by_space) for packs, pattern in by_space[space]]


def _places(capacity: int, oversize: int):
    """Rows of (group, lengths, counts) to rows of places: runs of containers with the ranks they take of a length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["group_id", "cost", "kind", "first_rank", "first_pack", "packs", "times"]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for group, bins in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                histogram = {b["cost"]: b["items"] for b in bins}
                too_long = histogram.pop(oversize, 0)
                ranks: dict[int, int] = {}
                pack = 0
                for packs, pattern in pack_histogram(histogram, capacity):
                    for length, times in pattern:
                        first = ranks.get(length, 0)
                        for column, value in zip(out, (group, length, PACKED, first, pack, packs, times)):
                            column.append(value)
                        ranks[length] = first + packs * times
                    pack += packs
                if too_long:
                    for column, value in zip(out, (group, oversize, OVERSIZED, 0, None, too_long, 1)):
                        column.append(value)
            types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types)], names=names)

    return run


def assign_packs(items: DataFrame, group: str, item: str, length: Column, capacity: int, separator: int = 1, salt_rows: int = 200_000, block: int = 10_000) -> DataFrame:
    """One row per item: ``group, item, length, kind, pack``; ``pack`` numbers the containers of a group from 0.

    ``length`` is the item's size; containers hold items whose sizes, with ``separator`` between two, sum to at most
    ``capacity``. An item above the capacity is of kind ``oversized``, alone and without a pack. A null length
    counts as 0. ``(group, item)`` is unique (see ``first_rows``); null groups form a group; items with a null id take
    part, told apart by their length only. Equal lengths are ranked by the item's hash, then id. Other columns of
    ``items`` are not looked at. An empty input gives no rows.
    """
    over = capacity + separator + 1
    rows = items.select(F.col(group).alias("group_id"), F.col(item).alias("item_id"), F.greatest(F.lit(0), F.coalesce(length, F.lit(0))).cast("bigint").alias("length"))
    rows = rows.withColumn("cost", F.when(F.col("length") > capacity, over).otherwise(F.col("length") + separator).cast("bigint"))
    rows = staged(rows, "items")
    counts = rows.groupBy("group_id", "cost").agg(F.count("*").alias("items"))
    largest = counts.agg(F.max("items")).first()[0] or 0
    salts = -(-largest // salt_rows) or 1
    salt = F.pmod(F.xxhash64("item_id"), F.lit(salts)).cast("int") if salts > 1 else F.lit(0)
    rows = rows.withColumn("salt", salt)
    local = Window.partitionBy("group_id", "cost", "salt").orderBy(F.xxhash64("item_id"), "item_id", "length")
    ranked = rows.withColumn("rank", F.row_number().over(local).cast("bigint") - 1)
    if salts > 1:
        before = Window.partitionBy("group_id", "cost").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
        shift = rows.groupBy("group_id", "cost", "salt").agg(F.count("*").alias("n")).withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
        same = [ranked[c].eqNullSafe(shift[c]) for c in ("group_id", "cost", "salt")]
        ranked = ranked.join(shift, same, "left").select(ranked["group_id"], ranked["item_id"], ranked["length"], ranked["cost"], (F.col("rank") + F.col("shift")).alias("rank"))
    bins = counts.groupBy("group_id").agg(F.collect_list(F.struct("cost", "items")).alias("bins"))
    kind = rows.schema["group_id"].dataType.simpleString()
    places = bins.mapInArrow(_places(capacity + separator, over), f"group_id {kind}, cost bigint, kind string, first_rank bigint, first_pack bigint, packs bigint, times bigint")
    # Long runs are cut into blocks of ranks before they are written out rank by rank.
    total = F.col("packs") * F.col("times")
    blocks = places.withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), total - 1, F.lit(block).cast("bigint")))).withColumn("to", F.least(F.col("at") + block, total) - 1)
    if salts > 1:
        blocks = blocks.repartition("group_id", "cost", "first_rank", "at")
    slots = blocks.withColumn("i", F.explode(F.sequence("at", "to"))).select("group_id", "cost", (F.col("first_rank") + F.col("i")).alias("rank"), "kind", (F.col("first_pack") + F.floor(F.col("i") / F.col("times")).cast("bigint")).alias("pack"))
    same = [ranked["group_id"].eqNullSafe(slots["group_id"]), ranked["cost"] == slots["cost"], ranked["rank"] == slots["rank"]]
    joined = ranked.join(slots, same, "inner")
    return joined.select(ranked["group_id"].alias(group), ranked["item_id"].alias(item), ranked["length"].alias("length"), "kind", "pack")


def containers(assigned: DataFrame, group: str, item: str, capacity: int, separator: int = 1) -> DataFrame:
    """One row per container: ``group, pack, item_ids, items, used, fill``; a container holds at most capacity + 1 items."""
    packed = assigned.where(F.col("kind") == PACKED).groupBy(group, "pack")
    made = packed.agg(F.sort_array(F.collect_list(item)).alias("item_ids"), F.count("*").alias("items"), (F.sum("length") + separator * (F.count("*") - 1)).alias("used"))
    return made.withColumn("fill", F.round(F.col("used") / F.lit(capacity), 6))
