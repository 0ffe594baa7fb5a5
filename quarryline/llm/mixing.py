"""Mixing sources to target weights by Pfair scheduling.

A mix is a sequence of blocks of equal size. A source of share u must have done u * t of its blocks by block t of the
sequence; its k-th block is released at floor(k / u) and due at ceil((k + 1) / u). Earliest-deadline-first over the
released blocks then keeps every source within less than one block of its share all along the sequence. A block takes its
tokens from what its source has left; one that comes too late or cannot be filled has missed, and a source with such a
block cannot reach its share. The number of blocks of a mix is fixed, the size of a block follows the total, so the
schedule is the same work for any total.

Documents take their place by the running sum of the tokens of their source, in the order of the MD5 of their id; copy e
of a source follows copy e - 1. Running sums are taken per bucket of that order and shifted by the sums of the buckets
before, so a source that holds a third of all documents is summed by many tasks. Shares are sums over the drawn documents.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import staged

#: A token is a run of letters, digits and underscores or any other single non-space character.
TOKEN = r"[\p{L}\p{N}_]+|[^\s\p{Z}\p{L}\p{N}_]"


def tokens(text: Column) -> Column:
    """Number of tokens of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("bigint")


def source_name(column: Column) -> Column:
    """A source name in lower case with ``_`` for ``-``, without outer spaces; null for an empty one."""
    bare = F.translate(F.lower(F.regexp_replace(column, r"^\s+|\s+$", "")), "-", "_")
    return F.when(bare != "", bare)


def edf(weights: list[float], blocks: int, serve: Callable[[int, int, bool], bool] = lambda i, k, late: True) -> list[list[int | None]]:
    """For each source the slots of its blocks, in order, in a sequence of ``blocks`` slots or a few more.

    Weights of 0 or less get no block. Source i gets ceil(share * blocks) blocks. Ties of deadlines go to the
    larger weight, then to the source given first. ``serve(source, block, late)`` fills a block; where it says False nothing
    was left for the block, which gets None, and the slot goes to the next one.
    """
    whole = sum(Fraction(w) for w in weights if w > 0)
    shares = [Fraction(w) / whole if w > 0 else Fraction(0) for w in weights]
    need = [math.ceil(u * blocks) for u in shares]
    slots: list[list[int | None]] = [[] for _ in weights]

    def entry(i: int) -> tuple:
        k = len(slots[i])
        return math.floor(k / shares[i]), math.ceil((k + 1) / shares[i]), -shares[i], i

    later = [entry(i) for i, n in enumerate(need) if n]  # by release
    heapq.heapify(later)
    ready: list[tuple] = []  # by deadline
    slot = 0
    while later or ready:
        while later and later[0][0] <= slot:
            heapq.heappush(ready, heapq.heappop(later)[1:])
        taken = False
        while ready and not taken:
            deadline, _, i = heapq.heappop(ready)
            taken = serve(i, len(slots[i]), slot >= deadline)
            slots[i].append(slot if taken else None)
            if len(slots[i]) < need[i]:
                ahead = entry(i)
                if ahead[0] <= slot and not taken:
                    heapq.heappush(ready, ahead[1:])
                else:
                    heapq.heappush(later, ahead)
        slot += 1
    return slots


_PLAN = "mix_id bigint, source string, target_tokens double, target_share double, planned_tokens double, tokens bigint, missed_blocks bigint, short boolean, block_tokens double, slots array<bigint>"


def _schedule(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _PLAN.split(", ")]
        types = [pa.int64(), pa.string(), *[pa.float64()] * 3, *[pa.int64()] * 2, pa.bool_(), pa.float64(), pa.list_(pa.int64())]
        for batch in batches:
            rows: list[tuple] = []
            for mix, total, sources in zip(*(batch.column(c).to_pylist() for c in ("mix_id", "total_tokens", "sources"))):
                sources = sorted(sources, key=lambda s: s["source"])
                whole = sum(Fraction(s["weight"]) for s in sources)
                size = Fraction(total, blocks)
                targets = [Fraction(s["weight"]) / whole * total if whole else Fraction(0) for s in sources]
                left = [s["max_repeats"] * s["tokens"] for s in sources]
                missed = [0] * len(sources)

                def serve(i: int, k: int, late: bool) -> bool:
                    wanted = min(size, targets[i] - k * size)
                    given = min(wanted, left[i])
                    left[i] -= given
                    missed[i] += late or given < wanted
                    return given > 0

                for i, (s, slots) in enumerate(zip(sources, edf([s["weight"] for s in sources], blocks if total else 0, serve))):
                    served = s["max_repeats"] * s["tokens"] - left[i]
                    rows.append((mix, s["source"], float(targets[i]), float(Fraction(s["weight"]) / whole) if whole else 0.0, round(float(served), 6), s["tokens"], missed[i], missed[i] > 0, float(size), slots))
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

    return run


def sized(documents: DataFrame, doc_id: str) -> DataFrame:
    """``doc_id, source, n``: the documents with a source, and their tokens."""
    return documents.select(F.col(doc_id).alias("doc_id"), source_name(F.col("source")).alias("source"), tokens(F.col("text")).alias("n")).where("source IS NOT NULL")


def mix_plan(sizes: DataFrame, targets: DataFrame, blocks: int = 4096) -> DataFrame:
    """One row per mix and source: target, tokens that the schedule serves, blocks that missed, and the slots of the blocks.

    ``sizes`` is as of ``sized``; ``targets`` has ``mix_id, source, weight, max_repeats, total_tokens``. Names are
    compared by ``source_name``. Null or negative weights, repeats and totals count as 0; several rows of a source in a
    mix add their weights and take the largest of the repeats; targets without a source or mix are left out. ``short`` marks
    sources with a block that missed: they cannot reach their share. Shares are not redistributed. A block that got nothing has a null slot.
    """
    of_source = sizes.groupBy("source").agg(F.sum("n").alias("tokens"))
    amount = lambda c: F.greatest(F.lit(0), F.coalesce(F.col(c), F.lit(0)))
    wanted = targets.select("mix_id", source_name(F.col("source")).alias("source"), amount("weight").cast("double").alias("weight"), amount("max_repeats").cast("bigint").alias("max_repeats"), amount("total_tokens").cast("bigint").alias("total_tokens"))
    wanted = wanted.where("mix_id IS NOT NULL AND source IS NOT NULL").groupBy("mix_id", "source").agg(F.sum("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"), F.max("total_tokens").alias("total_tokens"))
    joined = wanted.join(of_source, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    mixes = joined.groupBy("mix_id").agg(F.max("total_tokens").alias("total_tokens"), F.collect_list(F.struct("source", "weight", "max_repeats", "tokens")).alias("sources"))
    return mixes.mapInArrow(_schedule(blocks), _PLAN)


def deviations(plan: DataFrame, blocks: int = 4096) -> DataFrame:
    """``mix_id, source, deviation``: how far, in blocks, a source's blocks ever are from its share of the slots gone by.

    Looked at before and after each of its blocks up to slot ``blocks``, which is where the distance is largest. Blocks that got nothing count as done in their turn.
    """
    each = plan.select("mix_id", "source", "target_share", F.posexplode("slots").alias("k", "slot")).where(F.col("slot") < blocks)
    off = F.greatest(F.abs(F.col("k") + 1 - F.col("target_share") * (F.col("slot") + 1)), F.abs(F.col("k") - F.col("target_share") * F.col("slot")))
    return each.groupBy("mix_id", "source").agg(F.max(off).alias("deviation"))


def draw(sizes: DataFrame, plan: DataFrame, doc_id: str, plan_rows: int = 100_000, bucket_rows: int = 100_000) -> DataFrame:
    """The drawn documents: ``mix_id, source, doc_id, copy_no, block_no, slot, n``; sorting a mix by slot and id gives the sequence.

    A document is drawn in a copy if it begins before the tokens served to its source are reached. Documents without tokens are
    drawn with the one that follows them. Repeated rows are documents of their own, null ids come first. The plan, one row per mix and
    source, is broadcast if it has at most ``plan_rows`` rows, else joined by source. ``sizes`` and ``plan`` are read more than once: write them out before.
    """
    largest = sizes.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    buckets = max(1, -(-largest // bucket_rows))
    rows = sizes.withColumn("turn", F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit("")))
    rows = rows.withColumn("bucket", F.coalesce(F.shiftright(F.conv(F.substring("turn", 1, 8), 16, 10).cast("bigint") * buckets, 32), F.lit(0)))
    sums = rows.groupBy("source", "bucket").agg(F.sum("n").alias("m"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "bucket", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("source", "bucket").orderBy("turn", "doc_id", "n").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("at", F.coalesce(F.sum("n").over(within), F.lit(0))).join(sums, ["source", "bucket"]).withColumn("at", F.col("at") + F.col("shift"))
    small = plan.select("mix_id", "source", "planned_tokens", "tokens", "block_tokens", "slots").where("planned_tokens > 0")
    if plan.count() <= plan_rows:
        small = F.broadcast(small)
    copies = F.ceil((F.col("planned_tokens") - F.col("at")) / F.col("tokens")).cast("int")
    drawn = placed.join(small, "source").where(F.col("at") < F.col("planned_tokens")).withColumn("copy_no", F.explode(F.sequence(F.lit(0), copies - 1)))
    block = F.floor((F.col("copy_no") * F.col("tokens") + F.col("at")) / F.col("block_tokens")).cast("int")
    drawn = drawn.withColumn("block_no", block)
    return drawn.select("mix_id", "source", F.col("doc_id").alias(doc_id), "copy_no", "block_no", F.element_at("slots", F.least(F.col("block_no") + 1, F.size("slots"))).alias("slot"), "n")


def shares(plan: DataFrame, drawn: DataFrame) -> DataFrame:
    """The plan with ``drawn_tokens``, ``repeats`` and ``actual_share`` of each source, from the documents that were drawn."""
    taken = drawn.groupBy("mix_id", "source").agg(F.sum("n").alias("drawn_tokens"))
    rows = plan.drop("slots").join(taken, ["mix_id", "source"], "left").withColumn("drawn_tokens", F.coalesce("drawn_tokens", F.lit(0)))
    whole = F.sum("drawn_tokens").over(Window.partitionBy("mix_id"))
    rows = rows.withColumn("repeats", F.when(F.col("tokens") > 0, F.col("drawn_tokens") / F.col("tokens")).otherwise(0.0))
    return rows.withColumn("actual_share", F.when(whole > 0, F.col("drawn_tokens") / whole).otherwise(0.0))


def drawn_mix(documents: DataFrame, targets: DataFrame, doc_id: str, blocks: int = 4096) -> tuple[DataFrame, DataFrame]:
    """The plan and the drawn documents; texts are read once."""
    sizes = staged(sized(documents, doc_id), "sizes")
    plan = staged(mix_plan(sizes, targets, blocks), "plan")
    return plan, draw(sizes, plan, doc_id)
