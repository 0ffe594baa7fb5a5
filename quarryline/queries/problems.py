"""Queries of the core's two problem operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import millis, table
from ..operators.intervals import covered_periods, gaps
from ..operators.lecture_refs import lecture_ledger

GAP_MIN_MS, GAP_MAX_MS = 2_000, 3_600_000


def _speech(spark: SparkSession, directory: str) -> DataFrame:
    kinds = (("segment", "transcript_segments"), ("observation", "observations"))
    frames = [table(spark, directory, t, "lecture_id", "start_sec", "end_sec").select(F.lit(k).alias("record_kind"), "lecture_id", millis("start_sec").alias("s"), millis("end_sec").alias("e")) for k, t in kinds]
    return frames[0].unionByName(frames[1])


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    """Gaps of 2 s to 1 h, both included, in the segments and in the observations of each lecture."""
    rows = gaps(_speech(spark, directory), ["record_kind", "lecture_id"], "s", "e")
    return rows.where((F.col("gap_end_ms") - F.col("gap_start_ms")).between(GAP_MIN_MS, GAP_MAX_MS))


def p2_periods(spark: SparkSession, directory: str) -> DataFrame:
    """The continuous covered periods of each lecture."""
    return covered_periods(_speech(spark, directory), ["record_kind", "lecture_id"], "s", "e")


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    """References to absent, later or deleted records."""
    rows = lecture_ledger(spark, directory).orphans()
    return rows.select("ref_table", "ref_field", F.col("entity").alias("lecture_id"), "record_id", F.col("ref_key").alias("missing_key"))


def p4_monthly(spark: SparkSession, directory: str) -> DataFrame:
    """Orphans per referring table, column and month of arrival."""
    rows = lecture_ledger(spark, directory).snapshot("month")
    return rows.select("ref_table", "ref_field", F.date_format("period", "yyyy-MM").alias("month"), "orphans", "missing", "late", "deleted")


_COVER = """
WITH r AS (
  SELECT 'segment' AS record_kind, lecture_id, CAST(round(start_sec * 1000) AS BIGINT) AS s, CAST(round(end_sec * 1000) AS BIGINT) AS e FROM transcript_segments
  UNION ALL SELECT 'observation', lecture_id, CAST(round(start_sec * 1000) AS BIGINT), CAST(round(end_sec * 1000) AS BIGINT) FROM observations),
m AS (SELECT *, max(e) OVER (PARTITION BY record_kind, lecture_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r WHERE e > s)
"""

_P4 = """
WITH refs AS (
  SELECT 'graph_edges' AS ref_table, 'source' AS ref_field, 'graph_nodes' AS parent, lecture_id, CAST(edge_id AS VARCHAR) AS record_id, trim(source) AS k, ingested_at AS t FROM graph_edges
  UNION ALL SELECT 'graph_edges', 'target', 'graph_nodes', lecture_id, CAST(edge_id AS VARCHAR), trim(target), ingested_at FROM graph_edges
  UNION ALL SELECT 'graph_nodes', 'evidence_ids', 'observations', lecture_id, id, trim(unnest(evidence_ids)), ingested_at FROM graph_nodes
  UNION ALL SELECT 'linear_blocks', 'source_segment_ids', 'transcript_segments', lecture_id, id, trim(unnest(source_segment_ids)), ingested_at FROM linear_blocks),
r AS (SELECT ref_table, ref_field, parent, lecture_id, record_id, k, min(t) AS t FROM refs WHERE k <> '' GROUP BY ALL),
p AS (SELECT parent, lecture_id, k, min(t) AS first_at, max(t) AS last_at FROM (
  SELECT 'graph_nodes' AS parent, lecture_id, trim(id) AS k, ingested_at AS t FROM graph_nodes
  UNION ALL SELECT 'observations', lecture_id, trim(id), ingested_at FROM observations
  UNION ALL SELECT 'transcript_segments', lecture_id, trim(id), ingested_at FROM transcript_segments) GROUP BY ALL),
d AS (SELECT table_name AS parent, lecture_id, record_id AS k, max(deleted_at) AS deleted_at FROM deletion_log GROUP BY ALL),
o AS (SELECT r.*, CASE WHEN first_at IS NULL THEN 'missing' WHEN first_at > r.t THEN 'late' WHEN deleted_at IS NOT NULL AND last_at <= deleted_at THEN 'deleted' ELSE 'held' END AS status
  FROM r LEFT JOIN p USING (parent, lecture_id, k) LEFT JOIN d USING (parent, lecture_id, k))
"""

QUERIES = {"p2_found": p2_found, "p2_periods": p2_periods, "p4_found": p4_found, "p4_monthly": p4_monthly}
SQL = {
    "p2_found": _COVER + f"SELECT record_kind, lecture_id, before AS gap_start_ms, s AS gap_end_ms FROM m WHERE s - before BETWEEN {GAP_MIN_MS} AND {GAP_MAX_MS}",
    "p2_periods": _COVER
    + """, g AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY record_kind, lecture_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS n FROM m)
SELECT record_kind, lecture_id, min(s) AS period_start_ms, max(e) AS period_end_ms FROM g GROUP BY record_kind, lecture_id, n""",
    "p4_found": _P4 + "SELECT ref_table, ref_field, lecture_id, record_id, k AS missing_key FROM o WHERE status <> 'held'",
    "p4_monthly": _P4
    + """SELECT ref_table, ref_field, strftime(t, '%Y-%m') AS month, count(*) AS orphans, count(*) FILTER (status = 'missing') AS missing,
  count(*) FILTER (status = 'late') AS late, count(*) FILTER (status = 'deleted') AS deleted FROM o WHERE status <> 'held' GROUP BY ALL""",
}
