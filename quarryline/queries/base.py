"""Records of the lecture tables as delivered first, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import first_rows, millis, table

SEG = "SELECT lecture_id, id, arg_min(start_sec, ingested_at) AS start_sec, arg_min(end_sec, ingested_at) AS end_sec, min(text) AS text, min(confidence) AS confidence FROM transcript_segments GROUP BY 1, 2"
OBS = "SELECT lecture_id, id, min(window_id) AS window_id, min(start_sec) AS start_sec, min(end_sec) AS end_sec, min(kind) AS kind, min(text) AS text, min(latex) AS latex, min(target_observation_id) AS target_observation_id, min(confidence) AS confidence, min(source_status) AS source_status FROM observations GROUP BY 1, 2"
NODE = "SELECT DISTINCT lecture_id, id, kind, title, semantic_text, latex, status FROM graph_nodes"
EDGE = "SELECT DISTINCT edge_id, lecture_id, trim(source) AS source, trim(target) AS target, relation FROM graph_edges"
BLOCK = "SELECT DISTINCT lecture_id, id, block_type, title, latex, caption FROM linear_blocks"
CHUNK = "SELECT lecture_id, id, min(start_sec) AS start_sec, min(end_sec) AS end_sec, arg_min(segment_ids, ingested_at) AS segment_ids, min(text) AS text FROM lecture_chunks GROUP BY 1, 2"


def ms(c: str) -> str:
    """SQL of ``millis``."""
    return f"CAST(round({c} * 1000) AS BIGINT)"


def segments(spark: SparkSession, directory: str) -> DataFrame:
    """``lecture_id, id, s, e`` in milliseconds, ``text, confidence``."""
    rows = table(spark, directory, "transcript_segments", "lecture_id", "id", "start_sec", "end_sec", "text", "confidence", "ingested_at")
    kept = first_rows(rows, ["lecture_id", "id"], ["start_sec", "end_sec", "text", "confidence"])
    return kept.select("lecture_id", "id", millis("start_sec").alias("s"), millis("end_sec").alias("e"), "text", "confidence")


def observations(spark: SparkSession, directory: str) -> DataFrame:
    """Observations, with ``s, e`` in milliseconds."""
    columns = ["window_id", "start_sec", "end_sec", "kind", "text", "latex", "target_observation_id", "confidence", "source_status", "evidence_refs"]
    kept = first_rows(table(spark, directory, "observations", "lecture_id", "id", *columns, "ingested_at"), ["lecture_id", "id"], columns)
    return kept.withColumns({"s": millis("start_sec"), "e": millis("end_sec")}).drop("start_sec", "end_sec", "ingested_at")


def nodes(spark: SparkSession, directory: str) -> DataFrame:
    columns = ["kind", "title", "semantic_text", "latex", "evidence_ids", "derived_from", "aliases", "status"]
    return first_rows(table(spark, directory, "graph_nodes", "lecture_id", "id", *columns, "ingested_at"), ["lecture_id", "id"], columns).drop("ingested_at")


def edges(spark: SparkSession, directory: str) -> DataFrame:
    """Edges with ``src, dst`` without outer spaces."""
    rows = table(spark, directory, "graph_edges", "edge_id", "lecture_id", "source", "target", "relation")
    return rows.select("edge_id", "lecture_id", F.trim("source").alias("src"), F.trim("target").alias("dst"), "relation").distinct()


def blocks(spark: SparkSession, directory: str) -> DataFrame:
    columns = ["block_type", "title", "latex", "source_segment_ids", "visual_evidence_ids", "asset_path", "caption"]
    return first_rows(table(spark, directory, "linear_blocks", "lecture_id", "id", *columns, "ingested_at"), ["lecture_id", "id"], columns).drop("ingested_at")


def chunks(spark: SparkSession, directory: str) -> DataFrame:
    columns = ["start_sec", "end_sec", "segment_ids", "text"]
    kept = first_rows(table(spark, directory, "lecture_chunks", "lecture_id", "id", *columns, "ingested_at"), ["lecture_id", "id"], columns)
    return kept.withColumns({"s": millis("start_sec"), "e": millis("end_sec")}).drop("ingested_at")
