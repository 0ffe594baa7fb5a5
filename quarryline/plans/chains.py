"""Greedy runs over ordered rows, in blocks: each run starts where the one before says, and entities of any length are split.

Where a run ends and the next one starts depends only on the rows from its first one on, so a block of rows is a map from
the places where runs may enter it to the places where they leave it. All blocks work out their maps at once, a chain through
the maps (a few rows per block) finds where runs really enter, and all blocks then give out their runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fixpoint import NotConverged
from .grouped import fold_groups
from .scan import united, with_position
from .staging import staged

#: Columns to lists; (columns, first row, whether rows follow the last): (next first row or None for the end, last row), or None if more rows are needed.
Step = Callable[[dict[str, list], int, bool], "tuple[int | None, int] | None"]


def runs(df: DataFrame, keys: list[str], start: str, ties: list[str], columns: list[str], span_ms: int, step: Step, emit: Callable[[dict[str, list], int, int], dict], schema: str, block: int = 65_536, halo: int = 8_192) -> DataFrame:
    """Rows of ``schema`` (the keys and what ``emit`` gives), one per run of each entity, in order of ``start`` and ``ties``.

    A run reaches less than ``span_ms`` beyond the start of its first row, so only rows that start before that after the beginning of a block can be
    where a run enters it. A block sees ``halo`` rows of the next ones; if a run needs more, all is done again with twice as many. Null keys are an
    entity; ``start`` must not be null. Entities without rows give none.
    """
    wanted = list(dict.fromkeys([start, *columns]))
    placed = staged(with_position(df.select(*keys, *dict.fromkeys([*wanted, *ties])), keys, start, ties, name="_pos"), "placed")
    while True:
        if halo > block:
            block = 2 * halo
        try:
            return _runs(placed, keys, start, wanted, span_ms, step, emit, schema, block, halo)
        except NotConverged:
            halo *= 2


def _runs(placed: DataFrame, keys: list[str], start: str, columns: list[str], span_ms: int, step: Step, emit, schema: str, block: int, halo: int) -> DataFrame:
    own = F.floor(F.col("_pos") / block)
    near = F.when((F.pmod(F.col("_pos"), F.lit(block)) < halo) & (own > 0), own - 1)
    size = placed.groupBy(*keys).agg((F.max("_pos") + 1).alias("_n"))
    rows = placed.select(*keys, F.explode(F.array_compact(F.array(own, near))).alias("_b"), "_pos", *columns)
    ends = size.select(*keys, F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / block))).alias("_b"), F.lit(-2).cast("bigint").alias("_pos"), F.col("_n").alias("_mark"))
    types = ", ".join(f"`{k}` {placed.schema[k].dataType.simpleString()}" for k in keys)
    marked = united([rows.withColumn("_mark", F.lit(None).cast("bigint")), ends.select(*keys, "_b", "_pos", *[F.lit(None).cast(placed.schema[c].dataType).alias(c) for c in columns], "_mark")])

    def opened(part: list[dict]) -> tuple[dict[str, list], int, int, bool]:
        """Columns, place of the first row, rows of the block itself, and whether rows follow the last."""
        marks = [r for r in part if r["_pos"] < 0]
        held = [r for r in part if r["_pos"] >= 0]
        first = held[0]["_b"] * block
        return {c: [r[c] for r in held] for c in columns}, first, sum(r["_pos"] < first + block for r in held), held[-1]["_pos"] + 1 < marks[0]["_mark"]

    def mapped(part: list[dict]) -> list[dict]:
        values, first, rows_own, more = opened(part)
        starts = values[start]
        limit = starts[0] + span_ms
        entries = [0] if not first else [i for i in range(rows_own) if not i or starts[i - 1] < limit]
        out: dict[int, int | None] = {}
        for entry in entries:
            path, i = [], entry
            while i is not None and i < rows_own and i not in out:
                path.append(i)
                found = step(values, i, more)
                if found is None:
                    i = -1
                    break
                i = found[0]
            leaves = out[i] if i in out else i if i is None or i < 0 else first + i
            out |= dict.fromkeys(path, leaves)
        head = {k: part[0][k] for k in keys} | {"_b": part[0]["_b"]}
        return [{**head, "entry": first + i, "leaves": out[i]} for i in entries]

    maps = staged(fold_groups(marked, [*keys, "_b"], ["_pos"], mapped, f"{types}, _b bigint, entry bigint, leaves bigint"), "maps")

    def chained(part: list[dict]) -> list[dict]:
        at, head = 0, {k: part[0][k] for k in keys}
        out = []
        for r in part:  # by block, then entry
            if r["entry"] == at:
                if r["leaves"] == -1:
                    return [{**head, "_b": -1, "entry": -1}]
                out.append({**head, "_b": r["_b"], "entry": at})
                at = r["leaves"]
        return out

    entries = staged(fold_groups(maps, keys, ["_b", "entry"], chained, f"{types}, _b bigint, entry bigint"), "entries")
    if not entries.where("_b < 0").isEmpty():
        raise NotConverged(f"a run needs more than {halo} rows")
    marks = entries.select(*keys, "_b", F.lit(-1).cast("bigint").alias("_pos"), *[F.lit(None).cast(placed.schema[c].dataType).alias(c) for c in columns], F.col("entry").alias("_mark"))

    def given(part: list[dict]) -> list[dict]:
        entry = next((r["_mark"] for r in part if r["_pos"] == -1), None)
        if entry is None:
            return []
        values, first, rows_own, more = opened(part)
        head, out, i = {k: part[0][k] for k in keys}, [], entry - first
        while i is not None and i < rows_own:
            following, last = step(values, i, more)
            out.append({**head, **emit(values, i, last)})
            i = following
        return out

    return fold_groups(united([marked, marks]), [*keys, "_b"], ["_pos"], given, schema)
