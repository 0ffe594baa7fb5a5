"""Top-k, suppression, packing, budgets, retrieval, sampling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ranking
from ..plans.grouped import fold_groups
from ..sources.tables import millis, table
from . import base
from .base import OBS, SEG, ms


def deduped_requests(spark: SparkSession, directory: str) -> DataFrame:
    """Visual requests by priority, none within 20 s of one kept before."""
    r = table(spark, directory, "visual_requests", "lecture_id", "id", "ts_sec", "priority")
    r = r.select(F.lower(F.trim("lecture_id")).alias("lecture_id"), "id", millis("ts_sec").alias("at_ms"), "priority").distinct()
    return ranking.suppress(r, ["lecture_id"], "at_ms", [("priority", False), ("at_ms", True), ("id", True)], 20_000, "lecture_id string, id string, at_ms bigint, priority int")


def low_confidence_top(spark: SparkSession, directory: str) -> DataFrame:
    """The two segments of each window with the lowest confidence below 0.6."""
    c = base.chunks(spark, directory).select("lecture_id", F.col("id").alias("window_id"), F.explode("segment_ids").alias("id")).distinct()
    s = base.segments(spark, directory).where("confidence < 0.6").select("lecture_id", "id", "confidence", "s")
    ranked = ranking.top_per_key(c.join(s, ["lecture_id", "id"]), ["lecture_id", "window_id"], [F.asc("confidence"), F.asc_nulls_first("s"), F.asc("id")], 2)
    return ranked.select("lecture_id", "window_id", "id", "rank")


def lexical_top(spark: SparkSession, directory: str) -> DataFrame:
    """For every evaluation item the five documents that have most of its words."""
    q = table(spark, directory, "eval_items", "item_id", "text").toDF("query_id", "query")
    t = table(spark, directory, "documents", "doc_id", "text").toDF("text_id", "text")
    return ranking.lexical_top(q, t, 5).select("query_id", "text_id", F.round("score", 6).alias("score"), "rank")


def next_fit_payloads(spark: SparkSession, directory: str) -> DataFrame:
    """The observations of each window packed in order: 24 to a batch and 2,000 characters."""
    o = base.observations(spark, directory).select("lecture_id", "window_id", "id", (F.coalesce(F.length("text"), F.lit(0)) + F.coalesce(F.length("latex"), F.lit(0)) + 1).alias("n"))
    b = ranking.next_fit_bins(o, ["lecture_id", "window_id"], ["id"], "n", 2000, 24, "lecture_id string, window_id string, id string, n int, bin int")
    return b.groupBy("lecture_id", "window_id", "bin").agg(F.count("*").alias("items"), F.sum("n").alias("characters"))


def budget_prefixes(spark: SparkSession, directory: str) -> DataFrame:
    """The first observations of each lecture whose texts fit into 20,000 characters."""
    o = base.observations(spark, directory).where("s IS NOT NULL").select("lecture_id", "id", "s", F.length("text").alias("n"))
    return ranking.budget_prefix(o, ["lecture_id"], "s", ["id"], F.coalesce("n", F.lit(0)), 20_000).select("lecture_id", "id", "used")


def diverse_crops(spark: SparkSession, directory: str) -> DataFrame:
    """Eight crops of each lecture: the best of each moment first, then the best of the rest."""
    c = table(spark, directory, "formula_crops", "lecture_id", "id", "ts_sec", "detector_confidence")
    c = c.select(F.lower(F.trim("lecture_id")).alias("lecture_id"), "id", F.floor(F.col("ts_sec") / 60).alias("minute"), F.col("detector_confidence").alias("score")).distinct().where("minute IS NOT NULL")
    first = ranking.top_per_key(c, ["lecture_id", "minute"], [F.desc("score"), F.asc("id")], 8, "round")
    return ranking.top_per_key(first, ["lecture_id"], [F.asc("round"), F.desc("score"), F.asc("id")], 8).select("lecture_id", "id", "rank")


def suppressed_boxes(spark: SparkSession, directory: str) -> DataFrame:
    """Crops of a second that overlap no better one by 70 % or more."""
    c = table(spark, directory, "formula_crops", "lecture_id", "id", "ts_sec", "bbox", "detector_confidence").withColumns({"lecture_id": F.lower(F.trim("lecture_id")), "second": F.floor("ts_sec")})
    c = c.distinct().where("second IS NOT NULL AND size(bbox) = 4")

    def keep(rows: list[dict]) -> list[dict]:
        rows.sort(key=lambda r: (-(r["detector_confidence"] or 0.0), r["id"]))
        kept = ranking.suppress_boxes(np.array([r["bbox"] for r in rows], dtype=np.int64), 0.7)
        return [{k: rows[i][k] for k in ("lecture_id", "second", "id")} for i in kept]

    return fold_groups(c, ["lecture_id", "second"], ["id"], keep, "lecture_id string, second bigint, id string")


def uniform_frames(spark: SparkSession, directory: str) -> DataFrame:
    """Six segments of each window, evenly spread, ends included."""
    c = base.chunks(spark, directory).where("size(segment_ids) > 0")
    n = F.size("segment_ids")
    at = F.when(n <= 6, F.sequence(F.lit(0), n - 1)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.bround(i * (n - 1) / 5).cast("int"))))
    return c.select("lecture_id", "id", F.explode(at).alias("place"), "segment_ids").select("lecture_id", "id", "place", F.expr("segment_ids[place]").alias("segment_id"))


def sampled_events(spark: SparkSession, directory: str) -> DataFrame:
    """A tenth of the events, chosen by a hash of the id, the same on any number of tasks."""
    e = table(spark, directory, "events", "event_id", "event_type")
    return e.where(F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 4), 16, 10).cast("int") < 6554)


QUERIES = {f.__name__: f for f in (deduped_requests, low_confidence_top, lexical_top, next_fit_payloads, budget_prefixes, diverse_crops, suppressed_boxes, uniform_frames, sampled_events)}
_C = "SELECT DISTINCT lower(trim(lecture_id)) AS lecture_id, id, ts_sec, detector_confidence AS score FROM formula_crops WHERE ts_sec IS NOT NULL"
SQL = {
    "deduped_requests": f"""WITH RECURSIVE r AS (SELECT DISTINCT lower(trim(lecture_id)) AS lecture_id, id, {ms('ts_sec')} AS at_ms, priority FROM visual_requests WHERE ts_sec IS NOT NULL), p AS (SELECT *, row_number() OVER (PARTITION BY lecture_id ORDER BY priority DESC, at_ms, id) AS i FROM r),
w AS (SELECT lecture_id, id, at_ms, priority, i, true AS kept, [at_ms] AS k FROM p WHERE i = 1 UNION ALL
  SELECT p.lecture_id, p.id, p.at_ms, p.priority, p.i, len(list_filter(k, lambda x: abs(x - p.at_ms) <= 20000)) = 0, CASE WHEN len(list_filter(k, lambda x: abs(x - p.at_ms) <= 20000)) = 0 THEN list_append(k, p.at_ms) ELSE k END FROM w JOIN p ON p.lecture_id = w.lecture_id AND p.i = w.i + 1)
SELECT lecture_id, id, at_ms, priority FROM w WHERE kept""",
    "suppressed_boxes": """WITH RECURSIVE c AS (SELECT DISTINCT lower(trim(lecture_id)) AS lecture_id, id, CAST(floor(ts_sec) AS BIGINT) AS second, bbox, coalesce(detector_confidence, 0) AS score FROM formula_crops WHERE ts_sec IS NOT NULL AND len(bbox) = 4),
p AS (SELECT *, greatest(bbox[3] - bbox[1], 1) * greatest(bbox[4] - bbox[2], 1) AS area, row_number() OVER (PARTITION BY lecture_id, second ORDER BY score DESC, id) AS i FROM c),
w AS (SELECT lecture_id, second, id, i, true AS kept, [{'b': bbox, 'a': area}] AS k FROM p WHERE i = 1 UNION ALL
  SELECT lecture_id, second, id, i, NOT over, CASE WHEN over THEN k ELSE list_append(k, {'b': bbox, 'a': area}) END FROM (SELECT p.lecture_id, p.second, p.id, p.i, p.bbox, p.area, k,
    len(list_filter(k, lambda x: greatest(least(x.b[3], p.bbox[3]) - greatest(x.b[1], p.bbox[1]), 0) * greatest(least(x.b[4], p.bbox[4]) - greatest(x.b[2], p.bbox[2]), 0)
      >= 0.7 * (x.a + p.area - greatest(least(x.b[3], p.bbox[3]) - greatest(x.b[1], p.bbox[1]), 0) * greatest(least(x.b[4], p.bbox[4]) - greatest(x.b[2], p.bbox[2]), 0)))) > 0 AS over FROM w JOIN p ON p.lecture_id = w.lecture_id AND p.second = w.second AND p.i = w.i + 1))
SELECT lecture_id, second, id FROM w WHERE kept""",
    "next_fit_payloads": f"""WITH RECURSIVE o AS ({OBS}), p AS (SELECT lecture_id, window_id, coalesce(length(text), 0) + coalesce(length(latex), 0) + 1 AS n, row_number() OVER (PARTITION BY lecture_id, window_id ORDER BY id) AS i FROM o),
w AS (SELECT lecture_id, window_id, i, n, 0 AS bin, n AS used, 1 AS items FROM p WHERE i = 1 UNION ALL
  SELECT p.lecture_id, p.window_id, p.i, p.n, bin + CAST(used + p.n > 2000 OR items >= 24 AS INT), CASE WHEN used + p.n > 2000 OR items >= 24 THEN p.n ELSE used + p.n END, CASE WHEN used + p.n > 2000 OR items >= 24 THEN 1 ELSE items + 1 END FROM w JOIN p ON p.lecture_id = w.lecture_id AND p.window_id = w.window_id AND p.i = w.i + 1)
SELECT lecture_id, window_id, bin, count(*) AS items, sum(n) AS characters FROM w GROUP BY 1, 2, 3""",
    "low_confidence_top": f"WITH c AS (SELECT DISTINCT lecture_id, id AS window_id, unnest(segment_ids) AS id FROM ({base.CHUNK})), s AS ({SEG}) SELECT c.lecture_id, window_id, c.id, row_number() OVER (PARTITION BY c.lecture_id, window_id ORDER BY confidence, start_sec NULLS FIRST, c.id) AS rank FROM c JOIN s ON c.lecture_id = s.lecture_id AND c.id = s.id WHERE confidence < 0.6 QUALIFY rank <= 2",
    "lexical_top": r"WITH q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{3,}')) AS w FROM eval_items), n AS (SELECT item_id, count(*) AS n FROM q GROUP BY 1), t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{3,}')) AS w FROM documents), h AS (SELECT item_id, doc_id, count(*) AS k FROM q JOIN t USING (w) GROUP BY 1, 2) SELECT item_id AS query_id, doc_id AS text_id, round(k / n, 6) AS score, row_number() OVER (PARTITION BY item_id ORDER BY k / n DESC, doc_id) AS rank FROM h JOIN n USING (item_id) QUALIFY rank <= 5",
    "budget_prefixes": f"WITH o AS (SELECT lecture_id, id, {ms('start_sec')} AS s, coalesce(length(text), 0) AS n FROM ({OBS}) WHERE start_sec IS NOT NULL) SELECT lecture_id, id, sum(n) OVER (PARTITION BY lecture_id ORDER BY s, id ROWS UNBOUNDED PRECEDING) AS used FROM o QUALIFY used <= 20000",
    "diverse_crops": f"WITH c AS ({_C}), r AS (SELECT *, row_number() OVER (PARTITION BY lecture_id, floor(ts_sec / 60) ORDER BY score DESC, id) AS n FROM c) SELECT lecture_id, id, row_number() OVER (PARTITION BY lecture_id ORDER BY n, score DESC, id) AS rank FROM r QUALIFY rank <= 8",
    "uniform_frames": f"WITH c AS ({base.CHUNK}), x AS (SELECT lecture_id, id, segment_ids, len(segment_ids) AS n, unnest(range(0, least(6, len(segment_ids)))) AS i FROM c), p AS (SELECT DISTINCT lecture_id, id, segment_ids, CASE WHEN n <= 6 THEN i ELSE CAST(round_even(i * (n - 1) / 5, 0) AS BIGINT) END AS place FROM x) SELECT lecture_id, id, place, segment_ids[place + 1] AS segment_id FROM p",
    "sampled_events": "SELECT event_id, event_type FROM events WHERE CAST('0x' || left(md5(CAST(event_id AS VARCHAR)), 4) AS INT) < 6554",
}
