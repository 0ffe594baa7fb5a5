"""Greedy suppression, packing in order, budgets, retrieval and diverse choice."""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import total_ordering

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..plans.grouped import fold_groups
from ..plans.scan import null_safe_join, running, with_position
from ..plans.staging import staged
from .ordered import gap_sessions


def suppress(df: DataFrame, keys: list[str], at: str, order: list[tuple[str, bool]], within_ms: int, schema: str) -> DataFrame:
    """Rows kept greedily in ``order`` (column, ascending; the columns have no nulls): each unless a kept one lies within ``within_ms`` (inclusive).

    Rows further apart than ``within_ms`` never touch each other's fate, so each run of rows closer than that is a
    group of its own and an entity is spread over many tasks. Rows with a null time are left out.
    """
    rows = df.where(F.col(at).isNotNull())
    runs = gap_sessions(rows, keys, at, at, [c for c, _ in order], within_ms + 1, "_run")
    columns = [f.strip().split()[0] for f in schema.split(",")]

    def keep(part: list[dict]) -> list[dict]:
        for c, ascending in reversed(order):
            part.sort(key=lambda r: r[c], reverse=not ascending)  # noqa: B023
        kept: list[dict] = []
        chosen: list[int] = []
        for row in part:
            t = row[at]
            j = bisect_left(chosen, t)
            if (j < len(chosen) and chosen[j] - t <= within_ms) or (j and t - chosen[j - 1] <= within_ms):
                continue
            chosen.insert(j, t)
            kept.append({c: row[c] for c in columns})
        return kept

    return fold_groups(runs, [*keys, "_run"], [at], keep, schema)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], limit: int, name: str = "rank") -> DataFrame:
    """The first ``limit`` rows of each key; the limit is applied in every task before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= limit)


def next_fit(sizes: list[int], capacity: int, most: int) -> list[int]:
    """Bin numbers: an item opens a new bin when it would break the capacity or the number of items of the current one."""
    out, number, used, items = [], 0, 0, 0
    for size in sizes:
        if items and (used + size > capacity or items >= most):
            number, used, items = number + 1, 0, 0
        used, items = used + size, items + 1
        out.append(number)
    return out


def next_fit_bins(df: DataFrame, keys: list[str], order: list[str], size: str, capacity: int, most: int, schema: str) -> DataFrame:
    """Adds ``bin`` per row by ``next_fit`` in order within the keys, which must bound their rows (a window, a chunk)."""
    columns = [f.strip().split()[0] for f in schema.split(",")]

    def pack(rows: list[dict]) -> list[dict]:
        return [{**{c: r[c] for c in columns if c != "bin"}, "bin": n} for r, n in zip(rows, next_fit([r[size] for r in rows], capacity, most))]

    return fold_groups(df, keys, order, pack, schema)


def budget_prefix(df: DataFrame, keys: list[str], time: str, ties: list[str], size: Column, budget: int) -> DataFrame:
    """The rows of each entity, in order, whose running size stays within the budget."""
    placed = with_position(df, keys, time, ties, name="_pos")
    return running(placed, keys, "_pos", size, "sum", "used").where(F.col("used") <= budget).drop("_pos")


_LEXICAL = r"[\p{L}\p{N}_]{3,}"


def _best_texts(shared, limit: int, shape: pa.Schema):
    """Of the texts of a task the best ``limit`` per query, from the words of the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, of_word = shared.value
        find = regex.compile(_LEXICAL).findall
        best: list[list[tuple]] = [[] for _ in ids]  # heaps, the worst first: share, then the larger id
        for batch in batches:
            for text_id, text in zip(batch.column("text_id").to_pylist(), batch.column("text").to_pylist()):
                met = [of_word[w] for w in set(find((text or "").lower())) if w in of_word]
                if not met:
                    continue
                hits = np.bincount(np.concatenate(met), minlength=len(ids))
                for q in np.flatnonzero(hits).tolist():
                    entry = (hits[q] / counts[q], _Later(text_id))
                    if len(best[q]) < limit:
                        heapq.heappush(best[q], entry)
                    elif best[q][0] < entry:
                        heapq.heapreplace(best[q], entry)
        rows = [(ids[q], e[1].value, float(e[0])) for q, heap in enumerate(best) for e in heap]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows) if rows else [[]] * 3, shape)], schema=shape)

    return run


@total_ordering
@dataclass(frozen=True, eq=False)
class _Later:
    """An id by which the smaller one is the better, and null the best."""

    value: object

    def __eq__(self, other: object) -> bool:
        return self.value == other.value

    def __lt__(self, other: _Later) -> bool:
        return other.value is None and self.value is not None or (self.value is not None and other.value is not None and self.value > other.value)


def lexical_top(queries: DataFrame, texts: DataFrame, limit: int, broadcast_words: int = 1_000_000) -> DataFrame:
    """``query_id, text_id, score, rank``: share of a query's distinct words of three letters or more that a text has.

    While the queries have at most ``broadcast_words`` words in all, these go to the tasks, a text is scored where it is read, and a task
    gives out its best ``limit`` per query: frequent words make no hot keys. Beyond that queries and texts are joined by word. Null and
    repeated ids are ids like others; texts with none of a query's words do not rank.
    """
    words = lambda c: F.explode(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(_LEXICAL), F.lit(0))))
    q = staged(queries.select("query_id", words(F.col("query")).alias("w")), "query-words")
    if q.count() <= broadcast_words:
        rows = q.toArrow()
        place: dict = {}
        of_word: dict[str, list[int]] = {}
        for query_id, word in zip(rows.column("query_id").to_pylist(), rows.column("w").to_pylist()):
            of_word.setdefault(word, []).append(place.setdefault(query_id, len(place)))
        counts = np.bincount(np.concatenate(list(of_word.values())), minlength=len(place)) if of_word else np.zeros(0, int)
        shared = q.sparkSession.sparkContext.broadcast((list(place), counts, {w: np.array(i) for w, i in of_word.items()}))
        kinds = f"query_id {queries.schema['query_id'].dataType.simpleString()}, text_id {texts.schema['text_id'].dataType.simpleString()}, score double"
        scored = texts.select("text_id", "text").mapInArrow(_best_texts(shared, limit, to_arrow_schema(StructType.fromDDL(kinds))), kinds)
    else:
        n = q.groupBy("query_id").agg(F.count("*").alias("n"))
        t = texts.select("text_id", words(F.col("text")).alias("w")).join(q.select("w").distinct(), "w", "left_semi")
        hits = null_safe_join(q.join(t, "w").groupBy("query_id", "text_id").agg(F.count("*").alias("k")), n, ["query_id"])
        scored = hits.select("query_id", "text_id", (F.col("k") / F.col("n")).alias("score"))
    return top_per_key(scored, ["query_id"], [F.desc("score"), F.asc_nulls_first("text_id")], limit)


def suppress_boxes(boxes: np.ndarray, least: float) -> list[int]:
    """Indices of boxes ``(x0, y0, x1, y1)``, given in order of preference, that overlap no kept one by ``least`` or more."""
    kept: list[int] = []
    area = np.maximum(boxes[:, 2] - boxes[:, 0], 1) * np.maximum(boxes[:, 3] - boxes[:, 1], 1)
    for i, b in enumerate(boxes):
        k = boxes[kept]
        inner = np.maximum(np.minimum(k[:, 2], b[2]) - np.maximum(k[:, 0], b[0]), 0) * np.maximum(np.minimum(k[:, 3], b[3]) - np.maximum(k[:, 1], b[1]), 0)
        if not kept or (inner / (area[kept] + area[i] - inner)).max() < least:
            kept.append(i)
    return kept


def uniform_picks(n: int, limit: int) -> list[int]:
    """At most ``limit`` places spread evenly over n, ends included, rounded half to even; for a limit of 1 the last."""
    if n <= limit:
        return list(range(n))
    if limit <= 1:
        return [n - 1] if limit else []
    return list(dict.fromkeys(round(i * (n - 1) / (limit - 1)) for i in range(limit)))
