"""Candidate graphs and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import inference
from ..plans.grouped import fold_groups
from . import base
from .base import OBS, ms

#: Commands of structure that link nothing.
_STRUCTURE = tuple("\\" + name for name in "in quad qquad text forall exists bigl bigr lVert rVert lvert rvert to neq le ge Longrightarrow mathbb left right frac begin end cdot".split())


def sparse_edges(spark: SparkSession, directory: str) -> DataFrame:
    """Links of observations to the next one within 30 s, and by rare shared symbols within two minutes."""
    o = base.observations(spark, directory).where("s IS NOT NULL AND e IS NOT NULL")
    symbols = F.filter(T.symbols(F.col("latex"), _STRUCTURE), lambda x: F.length(x) > 1)
    return inference.sparse_edges(o, ["lecture_id"], symbols, 1, 30_000, 120_000)


def beam_readings(spark: SparkSession, directory: str) -> DataFrame:
    """For each window the best reading of its observations: each is kept, doubted or dropped; neighbours of one kind agree."""
    o = base.observations(spark, directory).select("lecture_id", "window_id", "id", "kind", F.coalesce("confidence", F.lit(0.5)).alias("confidence"))

    def fold(rows: list[dict]) -> list[dict]:
        unary = [[(f"{i}+", 2 * r["confidence"] - 1), (f"{i}?", 0.0), (f"{i}-", -0.15 - 0.7 * r["confidence"])] for i, r in enumerate(rows)]
        links = [[i - 1] if i else [] for i in range(len(rows))]
        agree = {(f"{i}{a}", f"{i + 1}{b}"): 0.25 if a == b else -0.25 for i in range(len(rows) - 1) if rows[i]["kind"] == rows[i + 1]["kind"] for a in "+?-" for b in "+?-"}
        score, path = inference.beam(unary, links, agree, 16, 1)[0]
        return [{"lecture_id": r["lecture_id"], "window_id": r["window_id"], "id": r["id"], "reading": c[-1], "score": score} for r, c in zip(rows, path)]

    return fold_groups(o, ["lecture_id", "window_id"], ["id"], fold, "lecture_id string, window_id string, id string, reading string, score double").select("lecture_id", "window_id", "id", "reading", F.round("score", 6).alias("score"))


def choice_marginals(spark: SparkSession, directory: str) -> DataFrame:
    """Per window the mass of each provenance by confidence."""
    o = base.observations(spark, directory).where("confidence IS NOT NULL")
    m = inference.marginals(o, ["lecture_id", "window_id"], "confidence", "source_status")
    return m.select("lecture_id", "window_id", "source_status", F.round("mass", 6).alias("mass"))


def pareto_windows(spark: SparkSession, directory: str) -> DataFrame:
    """Windows of each lecture with the fewest unresolved observations that no other beats in length and low confidence."""
    o = base.observations(spark, directory).where("s IS NOT NULL AND e IS NOT NULL")
    w = o.groupBy("lecture_id", "window_id").agg(F.count_if(F.col("kind") == "unresolved").alias("unresolved"), F.count_if(F.coalesce("confidence", F.lit(0.0)) < 0.8).alias("low"), (F.max("e") - F.min("s")).alias("length_ms"))
    return inference.pareto(w, ["lecture_id"], ["unresolved"], ["low", "length_ms"])


def best_candidates(spark: SparkSession, directory: str) -> DataFrame:
    """The observation of highest confidence per window and kind; the smallest id on a tie."""
    o = base.observations(spark, directory).where("confidence IS NOT NULL")
    return o.groupBy("lecture_id", "window_id", "kind").agg(F.min_by("id", F.struct(-F.col("confidence"), F.col("id"))).alias("id"))


QUERIES = {f.__name__: f for f in (sparse_edges, beam_readings, choice_marginals, pareto_windows, best_candidates)}
SQL = {
    "beam_readings": f"""WITH RECURSIVE p AS (SELECT lecture_id, window_id, id, kind, coalesce(confidence, 0.5) AS c, row_number() OVER (PARTITION BY lecture_id, window_id ORDER BY id) AS i, count(*) OVER (PARTITION BY lecture_id, window_id) AS n FROM ({OBS})),
u AS (SELECT *, lag(kind) OVER (PARTITION BY lecture_id, window_id ORDER BY i) AS before FROM p), g AS (SELECT u.*, x.r, x.o, CASE x.r WHEN '+' THEN 2 * c - 1 WHEN '?' THEN 0.0 ELSE -0.15 - 0.7 * c END AS own FROM u, (VALUES ('+', 0), ('?', 1), ('-', 2)) x(r, o)),
w AS (SELECT lecture_id, window_id, CAST(0 AS BIGINT) AS i, CAST(1 AS BIGINT) AS rank, CAST(0 AS DOUBLE) AS score, CAST([] AS VARCHAR[]) AS path FROM (SELECT DISTINCT lecture_id, window_id FROM p) UNION ALL
  SELECT lecture_id, window_id, i, rank, score, path FROM (SELECT g.lecture_id, g.window_id, g.i, w.score + g.own + CASE WHEN w.i > 0 AND g.kind = g.before THEN CASE WHEN w.path[w.i] = g.r THEN 0.25 ELSE -0.25 END ELSE 0 END AS score, list_append(w.path, g.r) AS path,
    row_number() OVER (PARTITION BY g.lecture_id, g.window_id ORDER BY w.score + g.own + CASE WHEN w.i > 0 AND g.kind = g.before THEN CASE WHEN w.path[w.i] = g.r THEN 0.25 ELSE -0.25 END ELSE 0 END DESC, w.rank, g.o) AS rank FROM w JOIN g ON g.lecture_id = w.lecture_id AND g.window_id = w.window_id AND g.i = w.i + 1) WHERE rank <= 16)
SELECT p.lecture_id, p.window_id, p.id, w.path[p.i] AS reading, round(w.score, 6) AS score FROM p JOIN w ON w.lecture_id = p.lecture_id AND w.window_id = p.window_id AND w.i = p.n AND w.rank = 1""",
    "sparse_edges": rf"""WITH o AS (SELECT lecture_id, id, {ms('start_sec')} AS s, {ms('end_sec')} AS e, list_filter(list_distinct(regexp_extract_all(coalesce(latex, ''), '\\[A-Za-z]+|[A-Za-z]')), lambda x: length(x) > 1 AND x NOT IN ({', '.join(f"'{x}'" for x in _STRUCTURE)})) AS y FROM ({OBS}) WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY lecture_id ORDER BY s, e, id) AS pos, count(*) OVER (PARTITION BY lecture_id) AS n FROM o),
t AS (SELECT lecture_id, id, pos, s, e, n, unnest(y) AS g FROM p), f AS (SELECT lecture_id, g, count(*) AS df FROM t GROUP BY 1, 2),
r AS (SELECT t.*, df FROM t JOIN f USING (lecture_id, g) WHERE df <= greatest(4, n // 3)),
q AS (SELECT a.lecture_id, a.id AS left_id, b.id AS right_id, b.pos, sum(CAST(round(1e6 / a.df) AS BIGINT)) AS w, min(greatest(0, b.s - a.e)) AS gap FROM r a JOIN r b ON a.lecture_id = b.lecture_id AND a.g = b.g AND b.pos > a.pos AND greatest(0, b.s - a.e) <= 120000 GROUP BY 1, 2, 3, 4)
SELECT a.lecture_id, a.id AS left_id, b.id AS right_id, 'temporal' AS reason FROM p a JOIN p b ON a.lecture_id = b.lecture_id AND b.pos = a.pos + 1 AND greatest(0, b.s - a.e) <= 30000
UNION ALL SELECT lecture_id, left_id, right_id, 'shared_symbol' FROM q QUALIFY row_number() OVER (PARTITION BY lecture_id, left_id ORDER BY w DESC, gap, pos) <= 2""",
    "choice_marginals": f"WITH o AS (SELECT * FROM ({OBS}) WHERE confidence IS NOT NULL), w AS (SELECT *, exp(greatest(-60.0, confidence - max(confidence) OVER (PARTITION BY lecture_id, window_id))) AS w FROM o) SELECT DISTINCT lecture_id, window_id, source_status, round(sum(w) OVER (PARTITION BY lecture_id, window_id, source_status) / sum(w) OVER (PARTITION BY lecture_id, window_id), 6) AS mass FROM w",
    "pareto_windows": f"WITH w AS (SELECT lecture_id, window_id, count(*) FILTER (kind = 'unresolved') AS unresolved, count(*) FILTER (coalesce(confidence, 0) < 0.8) AS low, max({ms('end_sec')}) - min({ms('start_sec')}) AS length_ms FROM ({OBS}) WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL GROUP BY 1, 2), b AS (SELECT * FROM w QUALIFY unresolved = min(unresolved) OVER (PARTITION BY lecture_id)) SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM b o WHERE o.lecture_id = b.lecture_id AND o.low <= b.low AND o.length_ms <= b.length_ms AND (o.low < b.low OR o.length_ms < b.length_ms))",
    "best_candidates": f"SELECT lecture_id, window_id, kind, first(id ORDER BY confidence DESC, id) AS id FROM ({OBS}) WHERE confidence IS NOT NULL GROUP BY 1, 2, 3",
}
