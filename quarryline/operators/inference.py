"""Candidate graphs: sparse edges, beam search, marginals, Pareto frontiers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scan import null_safe_join, shifted, with_position
from ..plans.staging import staged


def sparse_edges(df: DataFrame, keys: list[str], symbols: Column, span: int, gap_ms: int, symbol_gap_ms: int, per_left: int = 2, block_ms: int = 600_000) -> DataFrame:
    """``keys, left_id, right_id, reason``: links of each record to the next ``span`` records at most ``gap_ms`` later, and to the
    ``per_left`` later ones within ``symbol_gap_ms`` that share its rarest symbols.

    ``df`` has ``id, s, e``; null keys form an entity, rows with a null ``s`` link to nothing later. A symbol counts if at most a third of the entity's records, or four, have it. Shared symbols
    are found by a join on symbol and block of time, so a frequent symbol never pairs all its records.
    """
    placed = staged(with_position(df.select(*keys, "id", "s", "e", symbols.alias("symbols")), keys, "s", ["e", "id"]), "placed")
    near = None
    for by in range(1, span + 1):
        step = shifted(placed, keys, "pos", ["id", "s"], -by, "r_").where("r_s IS NOT NULL")
        step = step.where(F.greatest(F.lit(0), F.col("r_s") - F.col("e")) <= gap_ms).select(*keys, F.col("id").alias("left_id"), F.col("r_id").alias("right_id"), F.lit("temporal").alias("reason"))
        near = step if near is None else near.unionByName(step)
    each = placed.select(*keys, "id", "pos", "s", "e", F.explode("symbols").alias("symbol"))
    count = each.groupBy(*keys, "symbol").agg(F.count("*").alias("df"))
    total = placed.groupBy(*keys).agg(F.count("*").alias("n"))
    rare = null_safe_join(count, total, keys).where(F.col("df") <= F.greatest(F.lit(4), F.floor(F.col("n") / 3))).select(*keys, "symbol", "df")
    each = null_safe_join(each, rare, [*keys, "symbol"])
    block = lambda c: F.floor(c / block_ms)
    left = each.withColumn("b", F.explode(F.sequence(block(F.col("s")), block(F.greatest("s", "e") + symbol_gap_ms))))
    right = each.select(*keys, "symbol", block(F.col("s")).alias("b"), F.col("id").alias("r_id"), F.col("pos").alias("r_pos"), F.col("s").alias("rs"))
    gap = F.greatest(F.lit(0), F.col("rs") - F.col("e"))
    pairs = null_safe_join(left, right, [*keys, "symbol", "b"]).where((F.col("r_pos") > F.col("pos")) & (gap <= symbol_gap_ms))
    scored = pairs.groupBy(*keys, "id", "r_id", "r_pos").agg(F.sum(F.round(1e6 / F.col("df")).cast("bigint")).alias("rarity"), F.min(gap).alias("gap"))
    best = scored.groupBy(*keys, "id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("rarity")).alias("a"), "gap", "r_pos", "r_id"))), 1, per_left).alias("best"))
    shared = best.select(*keys, F.col("id").alias("left_id"), F.explode("best").alias("x")).select(*keys, "left_id", F.col("x.r_id").alias("right_id"), F.lit("shared_symbol").alias("reason"))
    return near.unionByName(shared)


def beam(unary: Sequence[Sequence[tuple[str, float]]], links: Sequence[Sequence[int]], pairwise: dict[tuple[str, str], float], width: int, top: int, weight: float = 1.0) -> list[tuple[float, tuple[str, ...]]]:
    """The best ``top`` assignments of a chain of candidate sets with sparse links back, by a beam of ``width``.

    ``unary[i]`` are (candidate, score); ``links[i]`` the earlier sets linked to i; ``pairwise`` scores (earlier, later)
    candidates, 0 where absent. Equal scores keep the order of expansion.
    """
    paths: list[tuple[float, tuple[str, ...]]] = [(0.0, ())]
    for i, options in enumerate(unary):
        grown = [(score + own + weight * sum(pairwise.get((path[j], name), 0.0) for j in links[i]), (*path, name)) for score, path in paths for name, own in options]
        paths = sorted(grown, key=lambda p: -p[0])[:width]
    return paths[:top] if unary else []


def marginals(scored: DataFrame, keys: list[str], score: str, choice: str) -> DataFrame:
    """``keys, choice, mass``: softmax weight of the hypotheses (score at least best - 60) with each choice."""
    best = scored.groupBy(*keys).agg(F.max(score).alias("_m"))
    weighed = scored.join(best, keys).withColumn("_w", F.exp(F.greatest(F.lit(-60.0), F.col(score) - F.col("_m"))))
    total = weighed.groupBy(*keys).agg(F.sum("_w").alias("_z"))
    return weighed.groupBy(*keys, choice).agg(F.sum("_w").alias("_w")).join(total, keys).select(*keys, choice, (F.col("_w") / F.col("_z")).alias("mass"))


def pareto(df: DataFrame, keys: list[str], hard: list[str], soft: list[str]) -> DataFrame:
    """The rows of each key with the least ``hard`` tuple that no other such row beats: none is as good in all ``soft``
    metrics and better in one. All metrics are to be small; rows with a null metric are left out.

    Each task keeps only the unbeaten points of what it has read so far, so what is shuffled and held is frontiers.
    """
    rows = df.dropna(subset=[*hard, *soft])
    least = rows.groupBy(*keys).agg(F.min(F.struct(*hard)).alias("_h"))
    best = rows.join(least, keys).where(F.struct(*hard) == F.col("_h")).drop("_h")
    points = best.select(*keys, *soft)
    typed = ", ".join(f"`{c}` {points.schema[c].dataType.simpleString()}" for c in points.columns)
    local = points.mapInArrow(_unbeaten(keys, soft), typed)
    frontier = local.repartition(*keys).mapInArrow(_unbeaten(keys, soft), typed)
    return best.join(frontier, [*keys, *soft], "left_semi")


def _unbeaten(keys: list[str], soft: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fronts: dict[tuple, set[tuple]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            columns = [batch.column(c).to_pylist() for c in (*keys, *soft)]
            for row in zip(*columns):
                front, point = fronts.setdefault(row[: len(keys)], set()), row[len(keys) :]
                if point in front or any(all(a <= b for a, b in zip(p, point)) for p in front):
                    continue
                front -= {p for p in front if all(a <= b for a, b in zip(point, p))}
                front.add(point)
        if schema:
            out = [(*k, *p) for k, front in fronts.items() for p in sorted(front)]
            order = [*keys, *soft]
            yield pa.RecordBatch.from_arrays([pa.array([r[order.index(f.name)] for r in out], f.type) for f in schema], schema=schema)

    return run
