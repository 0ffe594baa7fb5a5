"""Scans and projections: generated rows, slices of texts, shaped payloads, filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.tables import table
from . import base
from .base import NODE, OBS, ms

STEP_MS, CHUNK_CHARS = 600_000, 500


def timing_segments(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of ten minutes that cover each lecture from 0 to its end, the last one clipped."""
    ends = table(spark, directory, "transcript_segments", "lecture_id", "end_sec").groupBy("lecture_id").agg(F.max("end_sec").alias("m")).where("m > 0")
    rows = ends.withColumn("m", F.round(F.col("m") * 1000).cast("bigint")).where("m > 0")
    rows = rows.withColumn("n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("m") - 1) / STEP_MS))))
    return rows.select("lecture_id", F.col("n").alias("piece"), (F.col("n") * STEP_MS).alias("start_ms"), F.least("m", (F.col("n") + 1) * STEP_MS).alias("end_ms"))


def literature_slices(spark: SparkSession, directory: str) -> DataFrame:
    """Documents with white space collapsed, in slices of 500 characters, numbered."""
    rows = table(spark, directory, "documents", "doc_id", "text").withColumn("t", F.trim(F.regexp_replace("text", r"\s+", " "))).where("t <> ''")
    rows = rows.withColumn("n", F.explode(F.sequence(F.lit(0), F.floor((F.length("t") - 1) / CHUNK_CHARS).cast("int"))))
    return rows.select("doc_id", F.col("n").alias("slice_no"), F.expr(f"substring(t, n * {CHUNK_CHARS} + 1, {CHUNK_CHARS})").alias("slice"))


def seed_nodes(spark: SparkSession, directory: str) -> DataFrame:
    """A provisional node per observation."""
    o = base.observations(spark, directory)
    title = T.first_text(F.substring("text", 1, 120), F.substring("latex", 1, 120), F.lit("untitled"))
    return o.select("lecture_id", F.concat(F.lit("obs::"), "id").alias("node_id"), F.concat(F.lit("provisional_"), "kind").alias("kind"), F.col("id").alias("evidence_id"), title.alias("title"))


def state_projection(spark: SparkSession, directory: str) -> DataFrame:
    """Active nodes with their text chosen: semantic text, else title; and LaTeX where it is not blank."""
    n = base.nodes(spark, directory).where("status = 'active'")
    return n.select("lecture_id", "id", "kind", T.first_text(F.col("semantic_text"), F.col("title")).alias("body"), T.first_text(F.trim("latex")).alias("latex"))


def block_catalog(spark: SparkSession, directory: str) -> DataFrame:
    """Blocks with their LaTeX shortened around an ellipsis."""
    return base.blocks(spark, directory).select("lecture_id", "id", T.shortened(F.col("latex"), 80).alias("excerpt"), F.length("latex").alias("n_chars"))


def renderable_nodes(spark: SparkSession, directory: str) -> DataFrame:
    """Active, no longer provisional nodes with something to render and no open question in it."""
    n = base.nodes(spark, directory)
    body, tex = T.first_text(F.trim("semantic_text"), F.trim("title")), T.first_text(F.trim("latex"))
    keep = (F.col("status") == "active") & ~F.col("kind").startswith("provisional") & ~F.lower("kind").isin("topic", "section") & (body.isNotNull() | tex.isNotNull())
    return n.where(keep & ~F.coalesce(F.col("latex").contains("?"), F.lit(False))).select("lecture_id", "id", "kind")


def ambiguity_policy(spark: SparkSession, directory: str) -> DataFrame:
    """What to do with a node: omit topics and empty remarks, hold back proof steps without content, else render."""
    n = base.nodes(spark, directory)
    kind, empty = F.lower(F.regexp_replace("kind", "^provisional_", "")), T.first_text(F.trim("semantic_text"), F.trim("title"), F.trim("latex")).isNull()
    rule = F.when(kind.isin("topic", "transition"), "omit").when(kind.isin("remark", "example") & empty, "omit").when((kind == "proof_step") & empty, "omit").when(empty, "unresolved").otherwise("none")
    return n.select("lecture_id", "id", rule.alias("disposition"))


def requests_in_window(spark: SparkSession, directory: str) -> DataFrame:
    """Visual requests whose time lies in the window that their id names, ends included."""
    r = table(spark, directory, "visual_requests", "lecture_id", "id", "ts_sec").select(F.lower(F.trim("lecture_id")).alias("lecture_id"), "id", "ts_sec", F.regexp_extract("id", "^(window_[0-9]+)_", 1).alias("w")).distinct()
    c = base.chunks(spark, directory).select("lecture_id", F.col("id").alias("w"), "start_sec", "end_sec")
    return r.join(c, ["lecture_id", "w"]).where("ts_sec BETWEEN start_sec AND end_sec").select("lecture_id", F.col("id").alias("request_id"), F.col("w").alias("window_id"))


def state_tail(spark: SparkSession, directory: str) -> DataFrame:
    """The ten latest observations of each lecture; the rank is limited in each task before the shuffle."""
    o = base.observations(spark, directory).where("s IS NOT NULL")
    order = Window.partitionBy("lecture_id").orderBy(F.desc("s"), F.desc("id"))
    return o.withColumn("back", F.row_number().over(order)).where("back <= 10").select("lecture_id", F.col("back") - 1, "id").toDF("lecture_id", "back", "id")


_N = f"WITH n AS ({NODE})"
QUERIES = {f.__name__: f for f in (timing_segments, literature_slices, seed_nodes, state_projection, block_catalog, renderable_nodes, ambiguity_policy, requests_in_window, state_tail)}
SQL = {
    "timing_segments": f"WITH m AS (SELECT lecture_id, {ms('max(end_sec)')} AS m FROM transcript_segments GROUP BY 1), x AS (SELECT lecture_id, m, unnest(range(0, (m + {STEP_MS} - 1) // {STEP_MS})) AS piece FROM m WHERE m > 0) SELECT lecture_id, piece, piece * {STEP_MS} AS start_ms, least(m, (piece + 1) * {STEP_MS}) AS end_ms FROM x",
    "literature_slices": rf"WITH t AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents), x AS (SELECT doc_id, t, unnest(range(0, (length(t) + {CHUNK_CHARS} - 1) // {CHUNK_CHARS})) AS slice_no FROM t WHERE t <> '') SELECT doc_id, slice_no, substring(t, slice_no * {CHUNK_CHARS} + 1, {CHUNK_CHARS}) AS slice FROM x",
    "seed_nodes": f"WITH o AS ({OBS}) SELECT lecture_id, 'obs::' || id AS node_id, 'provisional_' || kind AS kind, id AS evidence_id, coalesce(nullif(left(text, 120), ''), nullif(left(latex, 120), ''), 'untitled') AS title FROM o",
    "state_projection": _N + " SELECT lecture_id, id, kind, coalesce(nullif(semantic_text, ''), nullif(title, '')) AS body, nullif(trim(latex), '') AS latex FROM n WHERE status = 'active'",
    "block_catalog": f"WITH b AS ({base.BLOCK}) SELECT lecture_id, id, CASE WHEN length(latex) > 80 THEN left(latex, 37) || ' ... ' || right(latex, 37) ELSE latex END AS excerpt, length(latex) AS n_chars FROM b",
    "renderable_nodes": _N + " SELECT lecture_id, id, kind FROM n WHERE status = 'active' AND NOT starts_with(kind, 'provisional') AND lower(kind) NOT IN ('topic', 'section') AND coalesce(nullif(trim(semantic_text), ''), nullif(trim(title), ''), nullif(trim(latex), '')) IS NOT NULL AND NOT coalesce(contains(latex, '?'), false)",
    "ambiguity_policy": _N
    + """, k AS (SELECT *, lower(regexp_replace(kind, '^provisional_', '')) AS k, coalesce(nullif(trim(semantic_text), ''), nullif(trim(title), ''), nullif(trim(latex), '')) IS NULL AS e FROM n)
SELECT lecture_id, id, CASE WHEN k IN ('topic', 'transition') THEN 'omit' WHEN k IN ('remark', 'example') AND e THEN 'omit' WHEN k = 'proof_step' AND e THEN 'omit' WHEN e THEN 'unresolved' ELSE 'none' END AS disposition FROM k""",
    "requests_in_window": f"WITH c AS ({base.CHUNK}), r AS (SELECT DISTINCT lower(trim(lecture_id)) AS lecture_id, id, ts_sec, regexp_extract(id, '^(window_[0-9]+)_', 1) AS w FROM visual_requests) SELECT r.lecture_id, r.id AS request_id, w AS window_id FROM r JOIN c ON c.lecture_id = r.lecture_id AND c.id = w WHERE ts_sec BETWEEN start_sec AND end_sec",
    "state_tail": f"WITH o AS ({OBS}) SELECT lecture_id, row_number() OVER (PARTITION BY lecture_id ORDER BY {ms('start_sec')} DESC, id DESC) - 1 AS back, id FROM o WHERE start_sec IS NOT NULL QUALIFY back < 10",
}
