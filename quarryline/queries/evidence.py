"""Evidence for sections, focus and budgets, rendering, edits and verification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import editing
from ..operators.joins import overlap_join
from ..operators.ranking import top_per_key
from ..plans.scan import neighbours, running, shifted, with_position
from ..sources.sinks import rendered
from ..sources.tables import millis, table
from . import base
from .base import BLOCK, CHUNK, OBS, ms

#: Blocks of so many consecutive numbers, where rows are ordered by the number in their id.
ORDINALS = 50_000


def focus_windows(spark: SparkSession, directory: str) -> DataFrame:
    """Windows that matter for each correction: the one it names, and those within 30 s of it."""
    o = base.observations(spark, directory).where("kind = 'correction'")
    c = base.chunks(spark, directory).select("lecture_id", F.col("id").alias("w"), F.col("s").alias("rs"), F.col("e").alias("re"))
    named = o.select("lecture_id", "id", F.col("window_id").alias("w")).join(c.select("lecture_id", "w"), ["lecture_id", "w"], "left_semi")
    wide = o.select("lecture_id", "id", (F.col("s") - 30_000).alias("s"), (F.col("e") + 30_000).alias("e"))
    near = overlap_join(wide, c, ["lecture_id"], 600_000).select("lecture_id", "id", "w")
    return named.select("lecture_id", "id", "w").unionByName(near).distinct().select("lecture_id", F.col("id").alias("observation_id"), F.col("w").alias("window_id"))


def catalog_prefix(spark: SparkSession, directory: str) -> DataFrame:
    """Per window, the prefix of its own observations that fits into 1,500 characters: statements first, then formulas, then the rest, by id."""
    o = base.observations(spark, directory).select("lecture_id", "window_id", "id", "kind", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    bucket = F.when(F.col("kind").isin("definition", "theorem", "claim"), 0).when(F.col("kind").isin("equation", "notation"), 1).otherwise(2)
    ranked = with_position(o.withColumn("bucket", bucket), ["lecture_id", "window_id"], "bucket", ["id"], 1)
    used = running(ranked, ["lecture_id", "window_id"], "pos", F.col("n"), "sum", "used")
    return used.where("used <= 1500").select("lecture_id", "window_id", "id", "bucket", "used")


def symbol_cutoff(spark: SparkSession, directory: str) -> DataFrame:
    """How many notations had been introduced by the start of each window: a running count, not an inequality join."""
    o = base.observations(spark, directory).where("kind = 'notation' AND s IS NOT NULL").select("lecture_id", F.col("s").alias("at"), F.lit(1).alias("one"), F.lit(None).cast("string").alias("w"), F.col("id").alias("tie"))
    c = base.chunks(spark, directory).where("s IS NOT NULL").select("lecture_id", F.col("s").alias("at"), F.lit(0).alias("one"), F.col("id").alias("w"), F.concat(F.lit("~"), "id").alias("tie"))
    placed = with_position(o.unionByName(c), ["lecture_id"], "at", ["tie"])
    return running(placed, ["lecture_id"], "pos", F.col("one"), "sum", "known").where("w IS NOT NULL").select("lecture_id", F.col("w").alias("window_id"), "known")


def edge_times(spark: SparkSession, directory: str) -> DataFrame:
    """The earliest evidence of each edge, with the number at the end of its id as a tie-break."""
    e = table(spark, directory, "graph_edges", "edge_id", "lecture_id", "evidence_ids").select("edge_id", "lecture_id", F.explode("evidence_ids").alias("id")).distinct()
    j = e.join(base.observations(spark, directory).select("lecture_id", "id", "s"), ["lecture_id", "id"]).where("s IS NOT NULL")
    n = F.coalesce(F.regexp_extract("id", r"_([0-9]+)$", 1).try_cast("bigint"), F.lit(0))
    return j.groupBy("edge_id").agg(F.min(F.col("s") * 1_000_000 + n).alias("at"))


def previous_tails(spark: SparkSession, directory: str) -> DataFrame:
    """For each block, the last 100 characters of the two before it."""
    b = base.blocks(spark, directory).withColumn("n", F.regexp_extract("id", r"_([0-9]+)$", 1).try_cast("bigint"))
    p = with_position(b.select("lecture_id", "id", "latex", "n"), ["lecture_id"], "n", ["id"], ORDINALS)
    p = neighbours(p, ["lecture_id"], "pos", ["latex"], {"b2_": 2, "b1_": 1})
    return p.select("lecture_id", "id", F.right(F.concat_ws("\n", "b2_latex", "b1_latex"), F.lit(100)).alias("tail"))


def rendered_blocks(spark: SparkSession, directory: str) -> DataFrame:
    """Blocks as TeX, with a heading where the title differs from the one before."""
    b = base.blocks(spark, directory).withColumn("n", F.regexp_extract("id", r"_([0-9]+)$", 1).try_cast("bigint"))
    p = shifted(with_position(b.select("lecture_id", "id", "block_type", "title", "latex", "n"), ["lecture_id"], "n", ["id"], ORDINALS), ["lecture_id"], "pos", ["title"], 1, "before_")
    fresh = (F.trim("title") != "") & ~F.col("title").eqNullSafe(F.col("before_title"))
    head = F.when(fresh, F.concat(F.lit("\\section{"), "title", F.lit("}\n"))).otherwise("")
    return p.select("lecture_id", "id", F.concat(head, rendered(F.col("block_type"), F.lit(None).cast("string"), F.col("latex"))).alias("tex"))


def neighbour_kinds(spark: SparkSession, directory: str) -> DataFrame:
    """Consecutive blocks of one type and title as one."""
    b = base.blocks(spark, directory).withColumn("n", F.regexp_extract("id", r"_([0-9]+)$", 1).try_cast("bigint"))
    p = with_position(b.select("lecture_id", "id", "block_type", "title", "n"), ["lecture_id"], "n", ["id"], ORDINALS, name="place")
    return editing.collapse_neighbours(p, ["lecture_id"], "place", F.concat_ws("\x1f", "block_type", F.coalesce("title", F.lit(""))))


def global_edit(spark: SparkSession, directory: str) -> DataFrame:
    """Blocks after a plan: exact copies merged into the first, empty ones dropped, the rest in a section by type; checked for coverage."""
    b = base.blocks(spark, directory).select("lecture_id", "id", "block_type", "latex")
    key = F.sha2(F.concat_ws("\x1f", "block_type", F.coalesce("latex", F.lit("\x00"))), 256)
    b = b.withColumn("key", key)
    j = b.join(b.groupBy("lecture_id", "key").agg(F.min("id").alias("into")), ["lecture_id", "key"])
    empty = F.coalesce(F.trim("latex"), F.lit("")) == ""
    action = F.when(empty, "drop").when(F.col("into") == F.col("id"), "keep").otherwise("merge")
    plan = j.select("lecture_id", "id", action.alias("action"), F.col("block_type").alias("section"), "into")
    edited = editing.edit_plan(b, plan, ["lecture_id"])
    return edited.select("lecture_id", "section", "id", F.array_join("sources", " ").alias("sources"))


def pair_scores(spark: SparkSession, directory: str) -> DataFrame:
    """Each pair of an edge of any relation with the score of its supports and uses, or an explicit 0."""
    e = base.edges(spark, directory).where("src IS NOT NULL AND dst IS NOT NULL")
    scored = e.where("relation IN ('supports', 'uses')").select("lecture_id", "src", "dst", F.col("edge_id").alias("pos"), F.when(F.col("relation") == "supports", 1.0).otherwise(0.5).alias("score"))
    return editing.complete_pairs(e, scored, ["lecture_id", "src", "dst"])


def segment_evidence(spark: SparkSession, directory: str) -> DataFrame:
    """Per block: observations that share a segment with it; where there are none, segments in its span."""
    b = base.blocks(spark, directory).select("lecture_id", F.col("id").alias("block_id"), F.explode("source_segment_ids").alias("seg")).distinct()
    o = base.observations(spark, directory).select("lecture_id", "id", F.explode("evidence_refs").alias("seg")).distinct()
    direct = b.join(o, ["lecture_id", "seg"]).groupBy("lecture_id", "block_id").agg(F.count_distinct("id").alias("n"), F.lit("observations").alias("how"))
    rest = b.join(direct, ["lecture_id", "block_id"], "left_anti").groupBy("lecture_id", "block_id").agg(F.count("*").alias("n"), F.lit("segments").alias("how"))
    return direct.unionByName(rest)


def ocr_candidates(spark: SparkSession, directory: str) -> DataFrame:
    """Crops for each request: those within a second if there are any, else within 20 s; the four surest."""
    r = table(spark, directory, "visual_requests", "lecture_id", "id", "ts_sec").select(F.lower(F.trim("lecture_id")).alias("lecture_id"), F.col("id").alias("request_id"), millis("ts_sec").alias("t")).distinct().where("t IS NOT NULL")
    c = table(spark, directory, "formula_crops", "lecture_id", "id", "ts_sec", "detector_confidence").select(F.lower(F.trim("lecture_id")).alias("lecture_id"), F.col("id").alias("crop_id"), millis("ts_sec").alias("rs"), "detector_confidence").distinct().withColumn("re", F.col("rs"))
    pairs = overlap_join(r.withColumns({"s": F.col("t") - 20_000, "e": F.col("t") + 20_000}), c, ["lecture_id"], 60_000).withColumn("near", (F.abs(F.col("rs") - F.col("t")) <= 1000).cast("int"))
    best = pairs.groupBy("lecture_id", "request_id").agg(F.max("near").alias("any"))
    chosen = pairs.join(best, ["lecture_id", "request_id"]).where("near = any")
    return top_per_key(chosen, ["lecture_id", "request_id"], [F.desc("detector_confidence"), F.asc("crop_id")], 4).select("lecture_id", "request_id", "crop_id", "rank")


QUERIES = {f.__name__: f for f in (focus_windows, catalog_prefix, symbol_cutoff, edge_times, previous_tails, rendered_blocks, neighbour_kinds, global_edit, pair_scores, segment_evidence, ocr_candidates)}
_B = f"b AS (SELECT *, TRY_CAST(regexp_extract(id, '_([0-9]+)$', 1) AS BIGINT) AS n FROM ({BLOCK}))"
_W = "OVER (PARTITION BY lecture_id ORDER BY n NULLS FIRST, id"
_CR = f"r AS (SELECT DISTINCT lower(trim(lecture_id)) AS lecture_id, id AS request_id, {ms('ts_sec')} AS t FROM visual_requests WHERE ts_sec IS NOT NULL), c AS (SELECT DISTINCT lower(trim(lecture_id)) AS lecture_id, id AS crop_id, {ms('ts_sec')} AS u, detector_confidence FROM formula_crops WHERE ts_sec IS NOT NULL)"
SQL = {
    "focus_windows": f"WITH o AS (SELECT lecture_id, id, window_id, {ms('start_sec')} AS s, {ms('end_sec')} AS e FROM ({OBS}) WHERE kind = 'correction'), c AS (SELECT lecture_id, id AS w, {ms('start_sec')} AS rs, {ms('end_sec')} AS re FROM ({CHUNK})) SELECT DISTINCT o.lecture_id, o.id AS observation_id, w AS window_id FROM o JOIN c ON o.lecture_id = c.lecture_id AND (o.window_id = w OR (s - 30000 <= e + 30000 AND rs <= re AND s - 30000 <= re AND rs <= e + 30000))",
    "catalog_prefix": f"WITH o AS (SELECT lecture_id, window_id, id, coalesce(length(text), 0) AS n, CASE WHEN kind IN ('definition', 'theorem', 'claim') THEN 0 WHEN kind IN ('equation', 'notation') THEN 1 ELSE 2 END AS bucket FROM ({OBS})) SELECT lecture_id, window_id, id, bucket, sum(n) OVER (PARTITION BY lecture_id, window_id ORDER BY bucket, id ROWS UNBOUNDED PRECEDING) AS used FROM o QUALIFY used <= 1500",
    "symbol_cutoff": f"WITH o AS (SELECT lecture_id, {ms('start_sec')} AS s FROM ({OBS}) WHERE kind = 'notation' AND start_sec IS NOT NULL), c AS (SELECT lecture_id, id, {ms('start_sec')} AS s FROM ({CHUNK}) WHERE start_sec IS NOT NULL) SELECT c.lecture_id, c.id AS window_id, count(o.s) AS known FROM c LEFT JOIN o ON o.lecture_id = c.lecture_id AND o.s <= c.s GROUP BY 1, 2",
    "edge_times": f"WITH e AS (SELECT DISTINCT edge_id, lecture_id, unnest(evidence_ids) AS id FROM graph_edges), o AS (SELECT lecture_id, id, {ms('start_sec')} AS s FROM ({OBS}) WHERE start_sec IS NOT NULL) SELECT edge_id, min(s * 1000000 + coalesce(TRY_CAST(regexp_extract(id, '_([0-9]+)$', 1) AS BIGINT), 0)) AS at FROM e JOIN o USING (lecture_id, id) GROUP BY 1",
    "previous_tails": f"WITH {_B} SELECT lecture_id, id, right(concat_ws(chr(10), lag(latex, 2) {_W}), lag(latex) {_W})), 100) AS tail FROM b",
    "rendered_blocks": rf"WITH {_B}, l AS (SELECT *, lag(title) {_W}) AS t FROM b) SELECT lecture_id, id, CASE WHEN trim(title) <> '' AND title IS DISTINCT FROM t THEN '\section{{' || title || '}}' || chr(10) ELSE '' END || CASE WHEN block_type = 'equation' THEN '\[' || chr(10) || coalesce(latex, '') || chr(10) || '\]' WHEN block_type IN ('definition', 'theorem', 'lemma', 'proof', 'example', 'remark', 'exercise') THEN '\begin{{' || block_type || '}}' || chr(10) || coalesce(latex, '') || chr(10) || '\end{{' || block_type || '}}' ELSE coalesce(latex, '') END AS tex FROM l",
    "neighbour_kinds": f"WITH {_B}, p AS (SELECT lecture_id, row_number() {_W}) - 1 AS pos, concat_ws(chr(31), block_type, coalesce(title, '')) AS c FROM b), l AS (SELECT *, CASE WHEN c = lag(c) OVER (PARTITION BY lecture_id ORDER BY pos) THEN 0 ELSE 1 END AS x FROM p), g AS (SELECT *, sum(x) OVER (PARTITION BY lecture_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS island FROM l) SELECT lecture_id, island, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS rows FROM g GROUP BY 1, 2",
    "global_edit": f"WITH b AS ({BLOCK}), f AS (SELECT *, min(id) OVER (PARTITION BY lecture_id, block_type, latex) AS into_id FROM b WHERE trim(coalesce(latex, '')) <> '') SELECT lecture_id, block_type AS section, into_id AS id, string_agg(id, ' ' ORDER BY id) AS sources FROM f GROUP BY 1, 2, 3",
    "pair_scores": "WITH e AS (SELECT DISTINCT edge_id, lecture_id, trim(source) AS src, trim(target) AS dst, relation FROM graph_edges WHERE source IS NOT NULL AND target IS NOT NULL), s AS (SELECT lecture_id, src, dst, arg_min(CASE WHEN relation = 'supports' THEN 1.0 ELSE 0.5 END, edge_id) AS score FROM e WHERE relation IN ('supports', 'uses') GROUP BY 1, 2, 3), w AS (SELECT DISTINCT lecture_id, src, dst FROM e) SELECT lecture_id, src, dst, coalesce(score, 0.0) AS score, CASE WHEN score IS NULL THEN 'uncertain' ELSE 'scored' END AS kind FROM w LEFT JOIN s USING (lecture_id, src, dst)",
    "segment_evidence": "WITH b AS (SELECT DISTINCT lecture_id, id AS block_id, unnest(source_segment_ids) AS seg FROM linear_blocks), o AS (SELECT DISTINCT lecture_id, id, unnest(evidence_refs) AS seg FROM observations), d AS (SELECT lecture_id, block_id, count(DISTINCT id) AS n, 'observations' AS how FROM b JOIN o USING (lecture_id, seg) GROUP BY 1, 2) SELECT * FROM d UNION ALL SELECT lecture_id, block_id, count(*), 'segments' FROM b ANTI JOIN d USING (lecture_id, block_id) GROUP BY 1, 2",
    "ocr_candidates": f"WITH {_CR}, p AS (SELECT r.lecture_id, request_id, crop_id, detector_confidence, abs(u - t) <= 1000 AS near FROM r JOIN c ON r.lecture_id = c.lecture_id AND abs(u - t) <= 20000), q AS (SELECT * FROM p QUALIFY near = bool_or(near) OVER (PARTITION BY lecture_id, request_id)) SELECT lecture_id, request_id, crop_id, row_number() OVER (PARTITION BY lecture_id, request_id ORDER BY detector_confidence DESC, crop_id) AS rank FROM q QUALIFY rank <= 4",
}
