"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import table
from . import base
from .base import CHUNK, NODE, OBS, SEG, ms

_RANK = ("inferred", "reconstructed", "observed")


def window_stats(spark: SparkSession, directory: str) -> DataFrame:
    """Per window, from its segments: span, number, mean confidence of those that have one, share below 0.6."""
    c = base.chunks(spark, directory).select("lecture_id", F.col("id").alias("window_id"), F.explode("segment_ids").alias("id"))
    joined = c.join(base.segments(spark, directory), ["lecture_id", "id"])
    low = F.avg(F.when(F.col("confidence").isNotNull(), (F.col("confidence") < 0.6).cast("double")))
    return joined.groupBy("lecture_id", "window_id").agg(F.min("s").alias("start_ms"), F.max("e").alias("end_ms"), F.count("*").alias("segments"), F.round(F.sum(F.round(F.col("confidence") * 1000).cast("bigint")) / F.count("confidence") / 1000, 5).alias("confidence"), F.round(low, 6).alias("low_fraction"))


def usage_rollup(spark: SparkSession, directory: str) -> DataFrame:
    """Counts and sums of events by type and in all."""
    e = table(spark, directory, "events", "event_type", "value")
    return e.rollup("event_type").agg(F.count("*").alias("calls"), F.round(F.sum("value"), 2).alias("amount"), F.grouping("event_type").cast("int").alias("total"))


def usage_delta(spark: SparkSession, directory: str) -> DataFrame:
    """What each lecture has more of in the second half of its nodes' arrivals than in the first, never below 0."""
    n = table(spark, directory, "graph_nodes", "lecture_id", "kind", "ingested_at")
    side = lambda half, name: n.where((F.dayofmonth("ingested_at") > 15) == F.lit(half)).groupBy("lecture_id", "kind").agg(F.count("*").alias(name))
    both = side(True, "after").join(side(False, "before"), ["lecture_id", "kind"], "full")
    return both.select("lecture_id", "kind", F.greatest(F.lit(0), F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0))).alias("delta")).where("delta > 0")


def state_metrics(spark: SparkSession, directory: str) -> DataFrame:
    """Per lecture: active nodes, nodes without evidence, surplus of nodes with one signature, edges."""
    n = base.nodes(spark, directory)
    active = n.where("status = 'active'")
    key = F.struct("kind", F.lower(F.trim(F.regexp_replace(F.coalesce("semantic_text", F.lit("")), r"\s+", " "))).alias("t"), F.regexp_replace(F.coalesce("latex", F.lit("")), r"\s+", "").alias("l"))
    twins = active.groupBy("lecture_id", key.alias("k")).count().groupBy("lecture_id").agg(F.sum(F.col("count") - 1).alias("duplicates"), F.sum("count").alias("active_nodes"))
    bare = active.groupBy("lecture_id").agg(F.count_if(F.coalesce(F.size("evidence_ids"), F.lit(0)) == 0).alias("unsupported"))
    lines = base.edges(spark, directory).groupBy("lecture_id").agg(F.countDistinct("edge_id").alias("edges"))
    whole = twins.join(bare, "lecture_id", "full").join(lines, "lecture_id", "full")
    return whole.select("lecture_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("active_nodes", "unsupported", "duplicates", "edges")])


def weakest_status(spark: SparkSession, directory: str) -> DataFrame:
    """Per window and kind the weakest provenance: inferred before reconstructed before observed."""
    o = base.observations(spark, directory)
    rank = F.array_position(F.array(*map(F.lit, _RANK)), F.col("source_status"))
    return o.groupBy("lecture_id", "window_id", "kind").agg(F.min_by("source_status", rank).alias("source_status"), F.count("*").alias("n"))


def softmax_marginals(spark: SparkSession, directory: str) -> DataFrame:
    """Per window the softmax weight of each kind by its best confidence."""
    o = base.observations(spark, directory).where("confidence IS NOT NULL").groupBy("lecture_id", "window_id", "kind").agg(F.max("confidence").alias("score"))
    w = Window.partitionBy("lecture_id", "window_id")  # one row per kind: at most as many as there are kinds
    o = o.withColumn("x", F.exp(F.greatest(F.lit(-60.0), F.col("score") - F.max("score").over(w))))
    return o.select("lecture_id", "window_id", "kind", F.round(F.col("x") / F.sum("x").over(w), 6).alias("mass"))


def unique_meaning(spark: SparkSession, directory: str) -> DataFrame:
    """Titles of a lecture's nodes that stand for exactly one text."""
    n = base.nodes(spark, directory).where("title <> '' AND semantic_text IS NOT NULL")
    return n.groupBy("lecture_id", "title").agg(F.min("semantic_text").alias("meaning"), F.max("semantic_text").alias("m")).where("meaning = m").drop("m")


def episode_summary(spark: SparkSession, directory: str) -> DataFrame:
    """First and last observation of each window by (start, end, id)."""
    o = base.observations(spark, directory).where("s IS NOT NULL AND e IS NOT NULL")
    by = F.struct("s", "e", "id")
    return o.groupBy("lecture_id", "window_id").agg(F.min_by("id", by).alias("first_id"), F.max_by("id", by).alias("last_id"), F.min("s").alias("start_ms"), F.max("e").alias("end_ms"))


def node_times(spark: SparkSession, directory: str) -> DataFrame:
    """Span of the evidence of each node."""
    n = base.nodes(spark, directory).select("lecture_id", F.col("id").alias("node_id"), F.explode("evidence_ids").alias("id"))
    joined = n.join(base.observations(spark, directory).select("lecture_id", "id", "s", "e"), ["lecture_id", "id"])
    return joined.groupBy("lecture_id", "node_id").agg(F.min("s").alias("start_ms"), F.max("e").alias("end_ms"))


def pricing_summary(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines by flag and status: sums, means and counts."""
    line = table(spark, directory, "lineitem", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate").where("l_shipdate <= DATE '1998-09-02'")
    return line.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("discount"), F.count("*").alias("lines"))


QUERIES = {f.__name__: f for f in (window_stats, usage_rollup, usage_delta, state_metrics, weakest_status, softmax_marginals, unique_meaning, episode_summary, node_times, pricing_summary)}
SQL = {
    "window_stats": f"WITH c AS (SELECT lecture_id, id AS window_id, unnest(segment_ids) AS id FROM ({CHUNK})), s AS ({SEG}) SELECT c.lecture_id, window_id, min({ms('start_sec')}) AS start_ms, max({ms('end_sec')}) AS end_ms, count(*) AS segments, round(sum(CAST(round(confidence * 1000) AS BIGINT)) / count(confidence) / 1000, 5) AS confidence, round(avg(CASE WHEN confidence IS NOT NULL THEN CAST(confidence < 0.6 AS INT) END), 6) AS low_fraction FROM c JOIN s ON c.lecture_id = s.lecture_id AND c.id = s.id GROUP BY 1, 2",
    "usage_rollup": "SELECT event_type, count(*) AS calls, round(sum(value), 2) AS amount, grouping(event_type) AS total FROM events GROUP BY ROLLUP (event_type)",
    "usage_delta": "WITH a AS (SELECT lecture_id, kind, count(*) FILTER (day(ingested_at) > 15) AS y, count(*) FILTER (day(ingested_at) <= 15) AS x FROM graph_nodes GROUP BY 1, 2) SELECT lecture_id, kind, greatest(0, y - x) AS delta FROM a WHERE y > x",
    "state_metrics": rf"WITH n AS (SELECT DISTINCT lecture_id, id, kind, semantic_text, latex, status, len(evidence_ids) AS k FROM graph_nodes), t AS (SELECT lecture_id, count(*) AS c, count(*) FILTER (coalesce(k, 0) = 0) AS u FROM n WHERE status = 'active' GROUP BY lecture_id, kind, lower(trim(regexp_replace(coalesce(semantic_text, ''), '\s+', ' ', 'g'))), regexp_replace(coalesce(latex, ''), '\s+', '', 'g')), m AS (SELECT lecture_id, sum(c) AS active_nodes, sum(u) AS unsupported, sum(c - 1) AS duplicates FROM t GROUP BY 1), e AS (SELECT lecture_id, count(DISTINCT edge_id) AS edges FROM graph_edges GROUP BY 1) SELECT lecture_id, coalesce(active_nodes, 0) AS active_nodes, coalesce(unsupported, 0) AS unsupported, coalesce(duplicates, 0) AS duplicates, coalesce(edges, 0) AS edges FROM m FULL JOIN e USING (lecture_id)",
    "weakest_status": f"WITH o AS ({OBS}) SELECT lecture_id, window_id, kind, arg_min(source_status, list_position(['inferred', 'reconstructed', 'observed'], source_status)) AS source_status, count(*) AS n FROM o GROUP BY 1, 2, 3",
    "softmax_marginals": f"WITH s AS (SELECT lecture_id, window_id, kind, max(confidence) AS score FROM ({OBS}) WHERE confidence IS NOT NULL GROUP BY 1, 2, 3), x AS (SELECT *, exp(greatest(-60.0, score - max(score) OVER (PARTITION BY lecture_id, window_id))) AS x FROM s) SELECT lecture_id, window_id, kind, round(x / sum(x) OVER (PARTITION BY lecture_id, window_id), 6) AS mass FROM x",
    "unique_meaning": f"WITH n AS ({NODE}) SELECT lecture_id, title, min(semantic_text) AS meaning FROM n WHERE title <> '' AND semantic_text IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT semantic_text) = 1",
    "episode_summary": f"WITH o AS (SELECT *, {ms('start_sec')} AS s, {ms('end_sec')} AS e FROM ({OBS}) WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL) SELECT lecture_id, window_id, first(id ORDER BY s, e, id) AS first_id, last(id ORDER BY s, e, id) AS last_id, min(s) AS start_ms, max(e) AS end_ms FROM o GROUP BY 1, 2",
    "node_times": f"WITH n AS (SELECT DISTINCT lecture_id, id AS node_id, unnest(evidence_ids) AS id FROM graph_nodes), o AS ({OBS}) SELECT n.lecture_id, node_id, min({ms('start_sec')}) AS start_ms, max({ms('end_sec')}) AS end_ms FROM n JOIN o ON n.lecture_id = o.lecture_id AND n.id = o.id GROUP BY 1, 2",
    "pricing_summary": "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS discount, count(*) AS lines FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY 1, 2",
}
