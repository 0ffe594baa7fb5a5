"""Joins: overlap, as-of, nearest, semi, anti, substring, snapshot difference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import asof_join, nearest_time, overlap_join
from ..sources.tables import table
from . import base
from .base import CHUNK, OBS, SEG, ms

RADIUS_MS = 15_000


def transcript_context(spark: SparkSession, directory: str) -> DataFrame:
    """How much is said within 15 s of the middle of each observation: segments and characters."""
    o = base.observations(spark, directory).where("s IS NOT NULL AND e IS NOT NULL")
    middle = F.floor((F.col("s") + F.col("e")) / 2)
    o = o.select("lecture_id", F.col("id").alias("observation_id"), (middle - RADIUS_MS).alias("s"), (middle + RADIUS_MS).alias("e"))
    g = base.segments(spark, directory).select("lecture_id", F.col("s").alias("rs"), F.col("e").alias("re"), F.length("text").alias("n"))
    found = overlap_join(o, g, ["lecture_id"], 30_000)
    return found.groupBy("lecture_id", "observation_id").agg(F.count("*").alias("segments"), F.coalesce(F.sum("n"), F.lit(0)).alias("characters"))


def asof_window(spark: SparkSession, directory: str) -> DataFrame:
    """The last window that starts at or before each formula crop."""
    crops = table(spark, directory, "formula_crops", "lecture_id", "id", "ts_sec").select(F.lower(F.trim("lecture_id")).alias("lecture_id"), "id", base.millis("ts_sec").alias("at")).distinct().where("at IS NOT NULL")
    c = base.chunks(spark, directory).select("lecture_id", F.col("s").alias("t"), F.col("id").alias("w"))
    return asof_join(crops, c, ["lecture_id"], "at", "t", "w", "window_id").select("lecture_id", F.col("id").alias("crop_id"), "window_id")


def window_fallback(spark: SparkSession, directory: str) -> DataFrame:
    """The window of an observation: the one it names, else, if that is absent, the one with the nearest middle."""
    o = base.observations(spark, directory).select("lecture_id", "id", "window_id", ((F.col("s") + F.col("e")) / 2).alias("m"))
    c = base.chunks(spark, directory)
    named = o.join(c.select("lecture_id", F.col("id").alias("window_id")), ["lecture_id", "window_id"], "left_semi").select("lecture_id", "id", "window_id", F.lit("named").alias("how"))
    lost = o.join(c.select("lecture_id", F.col("id").alias("window_id")), ["lecture_id", "window_id"], "left_anti").where("m IS NOT NULL")
    middles = c.select("lecture_id", F.col("id").alias("w"), ((F.col("s") + F.col("e")) / 2).alias("wm"))
    near = nearest_time(lost.drop("window_id"), middles, ["lecture_id"], "m", "wm", "w", "near").where("near IS NOT NULL")
    return named.unionByName(near.select("lecture_id", "id", F.col("near").alias("window_id"), F.lit("nearest").alias("how")))


def explained_evidence(spark: SparkSession, directory: str) -> DataFrame:
    """Observations that an active node or an edge cites."""
    n = base.nodes(spark, directory).where("status <> 'suppressed'").select("lecture_id", F.explode("evidence_ids").alias("id"))
    g = table(spark, directory, "graph_edges", "lecture_id", "evidence_ids").select("lecture_id", F.explode("evidence_ids").alias("id"))
    cited = n.unionByName(g).select("lecture_id", F.trim("id").alias("id")).distinct()
    return base.observations(spark, directory).join(cited, ["lecture_id", "id"], "left_semi").select("lecture_id", F.col("id").alias("observation_id"))


def unexplained_evidence(spark: SparkSession, directory: str) -> DataFrame:
    """Observations that nothing cites."""
    o = base.observations(spark, directory).select("lecture_id", F.col("id").alias("observation_id"))
    return o.join(explained_evidence(spark, directory), ["lecture_id", "observation_id"], "left_anti")


def substring_citations(spark: SparkSession, directory: str) -> DataFrame:
    """Observations whose LaTeX occurs literally in a block that cites one of their segments."""
    o = base.observations(spark, directory).withColumn("latex", F.btrim("latex", F.lit("$"))).where("length(latex) >= 4").select("lecture_id", F.col("id").alias("observation_id"), "latex", F.explode("evidence_refs").alias("seg")).distinct()
    b = base.blocks(spark, directory).select("lecture_id", F.col("id").alias("block_id"), F.col("latex").alias("body"), F.explode("source_segment_ids").alias("seg")).distinct()
    return o.join(b, ["lecture_id", "seg"]).where(F.col("body").contains(F.col("latex"))).select("lecture_id", "observation_id", "block_id").distinct()


def claims_of_observation(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes per observation that cite it, and the smallest id among them."""
    n = base.nodes(spark, directory).select("lecture_id", "id", F.explode(F.array_distinct("evidence_ids")).alias("observation_id")).where("observation_id IS NOT NULL")
    return n.groupBy("lecture_id", "observation_id").agg(F.count("*").alias("claims"), F.min("id").alias("first_claim"))


def window_snapshot_diff(spark: SparkSession, directory: str) -> DataFrame:
    """What a window has that the one before it lacks, and the other way round, by segment."""
    c = base.chunks(spark, directory).select("lecture_id", F.expr("cast(regexp_extract(id, '([0-9]+)$', 1) as int)").alias("n"), F.explode("segment_ids").alias("segment_id")).distinct()
    numbers = c.select("lecture_id", "n").distinct()
    before = c.select("lecture_id", (F.col("n") + 1).alias("n"), "segment_id", F.lit(True).alias("was")).join(numbers, ["lecture_id", "n"], "left_semi")
    both = c.withColumn("is", F.lit(True)).join(before, ["lecture_id", "n", "segment_id"], "full")
    return both.where("is IS NULL OR was IS NULL").select("lecture_id", F.col("n").alias("window_no"), "segment_id", F.when(F.col("is"), "added").otherwise("removed").alias("change"))


QUERIES = {f.__name__: f for f in (transcript_context, asof_window, window_fallback, explained_evidence, unexplained_evidence, substring_citations, claims_of_observation, window_snapshot_diff)}
_CITED = f"WITH o AS ({OBS}), c AS (SELECT lecture_id, trim(unnest(evidence_ids)) AS id FROM graph_nodes WHERE status <> 'suppressed' UNION SELECT lecture_id, trim(unnest(evidence_ids)) FROM graph_edges)"
SQL = {
    "transcript_context": f"WITH o AS (SELECT lecture_id, id, CAST(floor(({ms('start_sec')} + {ms('end_sec')}) / 2) AS BIGINT) AS m FROM ({OBS}) WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL), s AS (SELECT lecture_id, {ms('start_sec')} AS rs, {ms('end_sec')} AS re, text FROM ({SEG})) SELECT o.lecture_id, o.id AS observation_id, count(*) AS segments, coalesce(sum(length(text)), 0) AS characters FROM o JOIN s ON o.lecture_id = s.lecture_id AND rs <= m + {RADIUS_MS} AND re >= m - {RADIUS_MS} AND rs <= re GROUP BY 1, 2",
    "asof_window": f"WITH k AS (SELECT DISTINCT lower(trim(lecture_id)) AS lecture_id, id, {ms('ts_sec')} AS at FROM formula_crops WHERE ts_sec IS NOT NULL), c AS (SELECT lecture_id, {ms('start_sec')} AS t, max(id) AS w FROM ({CHUNK}) WHERE start_sec IS NOT NULL GROUP BY 1, 2) SELECT k.lecture_id, k.id AS crop_id, c.w AS window_id FROM k ASOF LEFT JOIN c ON k.lecture_id = c.lecture_id AND k.at >= c.t",
    "window_fallback": f"WITH o AS (SELECT lecture_id, id, window_id, ({ms('start_sec')} + {ms('end_sec')}) / 2 AS m FROM ({OBS})), c AS (SELECT lecture_id, id AS w, ({ms('start_sec')} + {ms('end_sec')}) / 2 AS wm FROM ({CHUNK})) SELECT o.lecture_id, id, window_id, 'named' AS how FROM o SEMI JOIN c ON o.lecture_id = c.lecture_id AND window_id = w UNION ALL SELECT o.lecture_id, id, first(w ORDER BY abs(m - wm), w), 'nearest' FROM (SELECT o.* FROM o ANTI JOIN c ON o.lecture_id = c.lecture_id AND window_id = w) o JOIN c ON o.lecture_id = c.lecture_id AND m IS NOT NULL AND wm IS NOT NULL GROUP BY 1, 2",
    "explained_evidence": _CITED + " SELECT o.lecture_id, o.id AS observation_id FROM o SEMI JOIN c ON o.lecture_id = c.lecture_id AND o.id = c.id",
    "unexplained_evidence": _CITED + " SELECT o.lecture_id, o.id AS observation_id FROM o ANTI JOIN c ON o.lecture_id = c.lecture_id AND o.id = c.id",
    "substring_citations": "WITH o AS (SELECT lecture_id, id, trim(latex, '$') AS latex, unnest(evidence_refs) AS seg FROM observations WHERE length(trim(latex, '$')) >= 4), b AS (SELECT lecture_id, id, latex, unnest(source_segment_ids) AS seg FROM linear_blocks) SELECT DISTINCT o.lecture_id, o.id AS observation_id, b.id AS block_id FROM o JOIN b ON o.lecture_id = b.lecture_id AND o.seg = b.seg AND contains(b.latex, o.latex)",
    "claims_of_observation": "WITH x AS (SELECT DISTINCT lecture_id, id, unnest(evidence_ids) AS observation_id FROM graph_nodes) SELECT lecture_id, observation_id, count(*) AS claims, min(id) AS first_claim FROM x WHERE observation_id IS NOT NULL GROUP BY 1, 2",
    "window_snapshot_diff": f"WITH c AS (SELECT DISTINCT lecture_id, CAST(regexp_extract(id, '([0-9]+)$', 1) AS INT) AS n, unnest(segment_ids) AS segment_id FROM ({CHUNK})), p AS (SELECT lecture_id, n + 1 AS n, segment_id FROM c WHERE (lecture_id, n + 1) IN (SELECT lecture_id, n FROM c)) SELECT lecture_id, n AS window_no, segment_id, 'added' AS change FROM (SELECT * FROM c EXCEPT SELECT * FROM p) UNION ALL SELECT lecture_id, n, segment_id, 'removed' FROM (SELECT * FROM p EXCEPT SELECT * FROM c)",
}
