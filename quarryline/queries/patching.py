"""Event-sourced status, guarded patches, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import patching
from . import base
from .base import OBS, ms


def claim_status(spark: SparkSession, directory: str) -> DataFrame:
    """Whether each observation still holds, by the last correction or retraction that names it."""
    o = base.observations(spark, directory)
    events = o.where("kind IN ('correction', 'retraction')").select("lecture_id", F.col("target_observation_id").alias("target"), "kind", F.coalesce("s", F.lit(-1)).alias("at"), F.col("id").alias("event_id"))
    return patching.event_status(o.where("kind NOT IN ('correction', 'retraction', 'transition', 'unresolved')"), events, ["lecture_id"])


def unresolvable_events(spark: SparkSession, directory: str) -> DataFrame:
    """Corrections and retractions that name nothing that exists."""
    o = base.observations(spark, directory)
    events = o.where("kind IN ('correction', 'retraction')").select("lecture_id", "id", "kind", F.col("target_observation_id").alias("target"))
    return events.join(o.select("lecture_id", F.col("id").alias("target")), ["lecture_id", "target"], "left_anti").select("lecture_id", "id", "kind")


def symbol_table(spark: SparkSession, directory: str) -> DataFrame:
    """LaTeX of notations per window: when first introduced and the last text given."""
    o = base.observations(spark, directory).where("kind = 'notation' AND latex IS NOT NULL")
    return o.groupBy("lecture_id", "window_id", F.col("latex").alias("symbol")).agg(F.min("s").alias("introduced_ms"), F.max_by("text", F.struct(F.coalesce("s", F.lit(-1)), "id")).alias("meaning"), F.count("*").alias("uses"))


def guarded_patches(spark: SparkSession, directory: str) -> DataFrame:
    """Corrections as patches: applied if the target exists, is observed earlier, and the confidence suffices; else why not."""
    o = base.observations(spark, directory)
    t = o.select("lecture_id", F.col("id").alias("target_observation_id"), F.col("s").alias("ts"), F.col("kind").alias("target_kind"))
    p = o.where("kind = 'correction'").join(t, ["lecture_id", "target_observation_id"], "left")
    rules = [("no target", F.col("target_kind").isNotNull()), ("empty", F.length(F.trim("text")) > 0), ("not earlier", F.col("ts") <= F.col("s")), ("low confidence", F.col("confidence") >= 0.6)]
    return patching.guarded(p, rules).select("lecture_id", "id", "applied", "reason")


def _mapping(spark: SparkSession, directory: str) -> DataFrame:
    n = base.nodes(spark, directory)
    firm = n.where("status = 'active' AND NOT startswith(kind, 'provisional')").select("lecture_id", F.col("id").alias("into"), F.explode("evidence_ids").alias("e"))
    soft = n.where("startswith(kind, 'provisional')").select("lecture_id", "id", F.explode("evidence_ids").alias("e"))
    return soft.join(firm, ["lecture_id", "e"]).groupBy("lecture_id", "id").agg(F.min("into").alias("into"))


def merged_nodes(spark: SparkSession, directory: str) -> DataFrame:
    """Provisional nodes merged into the first final node that shares their evidence: evidence per node."""
    n, e = base.nodes(spark, directory).select("lecture_id", "id", "evidence_ids"), base.edges(spark, directory)
    nodes, _ = patching.merge_into(n, e, _mapping(spark, directory), ["lecture_id"])
    return nodes.select("lecture_id", "id", F.array_join("evidence_ids", " ").alias("evidence"))


def merged_edges(spark: SparkSession, directory: str) -> DataFrame:
    """Edges after that merge."""
    n, e = base.nodes(spark, directory).select("lecture_id", "id", "evidence_ids"), base.edges(spark, directory)
    return patching.merge_into(n, e, _mapping(spark, directory), ["lecture_id"])[1]


def absorbed_nodes(spark: SparkSession, directory: str) -> DataFrame:
    """Provisional nodes whose evidence final nodes hold altogether."""
    n = base.nodes(spark, directory).select("lecture_id", "id", "kind", "evidence_ids", "status")
    after = patching.suppress_absorbed(n, ["lecture_id"]).select("lecture_id", "id", F.col("status").alias("after"))
    return n.join(after, ["lecture_id", "id"]).where("status <> after").select("lecture_id", "id")


QUERIES = {f.__name__: f for f in (claim_status, unresolvable_events, symbol_table, guarded_patches, merged_nodes, merged_edges, absorbed_nodes)}
_X = "x AS (SELECT DISTINCT lecture_id, id, kind, status, unnest(evidence_ids) AS e FROM graph_nodes), m AS (SELECT a.lecture_id, a.id, min(b.id) AS into_id FROM x a JOIN x b ON a.lecture_id = b.lecture_id AND a.e = b.e WHERE starts_with(a.kind, 'provisional') AND b.status = 'active' AND NOT starts_with(b.kind, 'provisional') GROUP BY 1, 2)"
SQL = {
    "claim_status": f"WITH o AS ({OBS}), e AS (SELECT lecture_id, target_observation_id AS t, last(kind ORDER BY coalesce({ms('start_sec')}, -1), id) AS k, last(id ORDER BY coalesce({ms('start_sec')}, -1), id) AS by_event FROM o WHERE kind IN ('correction', 'retraction') AND target_observation_id IS NOT NULL GROUP BY 1, 2) SELECT o.lecture_id, o.id, CASE k WHEN 'correction' THEN 'superseded' WHEN 'retraction' THEN 'retracted' ELSE 'active' END AS status, by_event FROM o LEFT JOIN e ON o.lecture_id = e.lecture_id AND o.id = t WHERE kind NOT IN ('correction', 'retraction', 'transition', 'unresolved')",
    "unresolvable_events": f"WITH o AS ({OBS}) SELECT lecture_id, id, kind FROM o WHERE kind IN ('correction', 'retraction') AND NOT EXISTS (SELECT 1 FROM o p WHERE p.lecture_id = o.lecture_id AND p.id = o.target_observation_id)",
    "symbol_table": f"WITH o AS ({OBS}) SELECT lecture_id, window_id, latex AS symbol, min({ms('start_sec')}) AS introduced_ms, last(text ORDER BY coalesce({ms('start_sec')}, -1), id) AS meaning, count(*) AS uses FROM o WHERE kind = 'notation' AND latex IS NOT NULL GROUP BY 1, 2, 3",
    "guarded_patches": f"WITH o AS ({OBS}), p AS (SELECT o.lecture_id, o.id, CASE WHEN t.kind IS NULL THEN 'no target' WHEN NOT coalesce(length(trim(o.text)) > 0, false) THEN 'empty' WHEN NOT coalesce({ms('t.start_sec')} <= {ms('o.start_sec')}, false) THEN 'not earlier' WHEN NOT coalesce(o.confidence >= 0.6, false) THEN 'low confidence' ELSE 'ok' END AS reason FROM o LEFT JOIN o t ON t.lecture_id = o.lecture_id AND t.id = o.target_observation_id WHERE o.kind = 'correction') SELECT lecture_id, id, reason = 'ok' AS applied, reason FROM p",
    "merged_nodes": f"WITH {_X}, n AS (SELECT DISTINCT lecture_id, id FROM graph_nodes), r AS (SELECT n.lecture_id, coalesce(into_id, n.id) AS id, x.e FROM n LEFT JOIN m ON m.lecture_id = n.lecture_id AND m.id = n.id LEFT JOIN x ON x.lecture_id = n.lecture_id AND x.id = n.id) SELECT lecture_id, id, coalesce(string_agg(DISTINCT e, ' ' ORDER BY e), '') AS evidence FROM r GROUP BY 1, 2",
    "merged_edges": f"WITH {_X}, e AS (SELECT DISTINCT lecture_id, trim(source) AS s, trim(target) AS t, relation FROM graph_edges), r AS (SELECT e.lecture_id, coalesce(a.into_id, s) AS src, coalesce(b.into_id, t) AS dst, relation FROM e LEFT JOIN m a ON a.lecture_id = e.lecture_id AND a.id = s LEFT JOIN m b ON b.lecture_id = e.lecture_id AND b.id = t) SELECT DISTINCT * FROM r WHERE src <> dst",
    "absorbed_nodes": f"WITH {_X}, f AS (SELECT DISTINCT lecture_id, e FROM x WHERE status = 'active' AND NOT starts_with(kind, 'provisional') AND kind NOT IN ('topic', 'section', 'subsection')) SELECT x.lecture_id, id FROM x LEFT JOIN f ON f.lecture_id = x.lecture_id AND f.e = x.e WHERE status = 'active' AND starts_with(kind, 'provisional') GROUP BY 1, 2 HAVING bool_and(f.e IS NOT NULL)",
}
