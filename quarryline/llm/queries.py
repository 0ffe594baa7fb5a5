"""Queries of the training-data operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scan import null_safe_join
from ..plans.staging import staged
from ..sources.tables import first_rows, millis, table
from . import contamination, mixing, nearest, packing, pii, splitting

CAPACITY, LIMIT, OVERLAP = 1_200, 8_000, 400
#: Up to so many segments named by chunks without a text go to the tasks as a filter of the segments; more are joined with all of them.
NAMED_ROWS = 500_000
SEGMENT_TOLERANCE_MS, CROP_TOLERANCE_MS = 2_500, 8_000


def _packed(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "transcript_segments", "lecture_id", "id", "text", "ingested_at")
    sized = rows.select("lecture_id", F.col("id").alias("segment_id"), F.length(F.trim("text")).alias("size"), "ingested_at")
    items = first_rows(sized, ["lecture_id", "segment_id"], ["size"])
    return packing.assign_packs(items, "lecture_id", "segment_id", F.col("size"), CAPACITY)


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    """Segments too long for a chunk of 1,200 characters."""
    return _packed(spark, directory).where(F.col("kind") == packing.OVERSIZED).select("lecture_id", "segment_id")


def p1_chunks(spark: SparkSession, directory: str) -> DataFrame:
    """The chunks of each lecture with their segment ids and fill."""
    return packing.containers(_packed(spark, directory), "lecture_id", "segment_id", CAPACITY)


def p1_checked(spark: SparkSession, directory: str) -> DataFrame:
    """Per lecture what its chunks hold, whether each is within the capacity, and whether they are few: at most 1.1 times the least possible, and one."""
    chunks = p1_chunks(spark, directory)
    rows = chunks.groupBy("lecture_id").agg(F.sum("items").alias("segments"), F.sum(F.size(F.array_distinct("item_ids"))).alias("named"), F.sum(F.col("used") - (F.col("items") - 1)).alias("characters"), F.max("used").alias("most"), F.count("*").alias("chunks"))
    within = (F.col("most") <= CAPACITY) & (F.col("named") == F.col("segments"))
    few = F.col("chunks") <= F.ceil((F.col("characters") + F.col("segments")) / (CAPACITY + 1)) * 1.1 + 1
    return rows.select("lecture_id", "segments", "characters", within.alias("within"), few.alias("few"))


def _bare(column: str) -> Column:
    return F.lower(F.regexp_replace(column, r"^\s+|\s+$", ""))


def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    """For each visual request the segment with the nearest start and the crop with the nearest time, where near enough."""

    def records(name: str, at: str) -> DataFrame:
        return table(spark, directory, name, "lecture_id", "id", at).select(_bare("lecture_id").alias("entity"), millis(at).alias("at"), "id")

    requests = records("visual_requests", "ts_sec").groupBy("entity", "id").agg(F.min("at").alias("at"))
    segment = nearest.nearest(requests, records("transcript_segments", "start_sec"), SEGMENT_TOLERANCE_MS)
    crop = nearest.nearest(requests, records("formula_crops", "ts_sec"), CROP_TOLERANCE_MS)
    both = segment.withColumn("match_kind", F.lit("segment")).unionByName(crop.withColumn("match_kind", F.lit("crop"))).where("match_id IS NOT NULL")
    written = table(spark, directory, "transcript_segments", "lecture_id").groupBy(_bare("lecture_id").alias("entity")).agg(F.min("lecture_id").alias("lecture_id"))
    named = both.join(written, "entity", "left")
    return named.select(F.coalesce("lecture_id", "entity").alias("lecture_id"), F.col("left_id").alias("request_id"), "match_kind", "match_id")


def p5_pieces(spark: SparkSession, directory: str) -> DataFrame:
    """The pieces of the lecture chunks above 8,000 characters, each repeating 400 characters of the one before."""
    chunks = table(spark, directory, "lecture_chunks", "lecture_id", "id", "text", "segment_ids", "ingested_at")
    chunks = chunks.where(F.col("text").isNull() | (F.length("text") > LIMIT)).withColumnRenamed("id", "chunk_id")
    chunks = first_rows(chunks, ["lecture_id", "chunk_id"], ["text", "segment_ids"])
    chunks = staged(chunks, "long-chunks")
    keys = ["lecture_id", "chunk_id"]
    named = chunks.select(*keys, F.posexplode_outer("segment_ids").alias("place", "id"))
    segments = table(spark, directory, "transcript_segments", "lecture_id", "id", "text", "ingested_at")

    def listed(names: DataFrame, of: DataFrame, value: Column) -> DataFrame:
        """Per chunk the values of its segments in order; a segment delivered twice counts as it first arrived."""
        one = F.struct("place", F.col("ingested_at").isNull().alias("late"), "ingested_at", value.alias("v"))
        rows = names.join(of, ["lecture_id", "id"], "left").groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("l"))
        return rows.select(*keys, F.expr("transform(filter(l, (x, i) -> i = 0 OR x.place <> l[greatest(i - 1, 0)].place), x -> x.v)").alias("v"))

    # Of most segments only the length and hash are moved; texts go only to the chunks that have none of their own.
    parts = listed(named, segments.withColumn("part", splitting.part_of(F.col("id"), F.col("text"))).drop("text"), F.struct(F.coalesce("part.id", "id").alias("id"), F.coalesce("part.size", F.lit(0)).alias("size"), F.coalesce("part.hash", F.lit(0).cast("bigint")).alias("hash")))
    bare = chunks.where("text IS NULL").select(*keys, F.posexplode("segment_ids").alias("place", "id"))
    if bare.count() <= NAMED_ROWS:
        segments = segments.join(F.broadcast(bare.select("lecture_id", "id").distinct()), ["lecture_id", "id"], "left_semi")
    own = listed(bare, segments, F.col("text")).withColumn("own", F.array_join(F.filter("v", lambda t: t != ""), "\n")).drop("v")
    rows = null_safe_join(null_safe_join(chunks, parts.withColumnRenamed("v", "parts"), keys, "left"), own, keys, "left")
    texts = rows.select(*keys, F.coalesce("text", "own").alias("text"), "parts")
    return splitting.split_oversized(texts, ["lecture_id", "chunk_id"], LIMIT, OVERLAP)


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    """Chunks with more than 8,000 characters: those that the operator cut."""
    return p5_pieces(spark, directory).where("piece_no = 1").select("lecture_id", "chunk_id")


def p5_checked(spark: SparkSession, directory: str) -> DataFrame:
    """Per chunk that was cut: the hash of its content put together again from the pieces, and whether all pieces are within the limit."""
    listed = p5_pieces(spark, directory).groupBy("lecture_id", "chunk_id").agg(F.sort_array(F.collect_list(F.struct("piece_no", "text"))).alias("l"), F.max(F.length("text")).alias("longest"))
    whole = F.expr(f"array_join(transform(l, (x, i) -> if(i = 0, x.text, substring(x.text, {OVERLAP + 1}))), '')")
    return listed.select("lecture_id", "chunk_id", F.md5(whole.cast("binary")).alias("content_md5"), (F.col("longest") <= LIMIT).alias("within"))


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    """Documents that repeat 12 or more consecutive words of an evaluation item."""
    return contamination.leaked_items(table(spark, directory, "documents", "doc_id", "text"), table(spark, directory, "eval_items", "item_id", "text"), "doc_id", "item_id")


def p7_found(spark: SparkSession, directory: str) -> DataFrame:
    """Sources that cannot reach their share of a mix: those with a block that the schedule could not fill in time."""
    sizes = mixing.sized(table(spark, directory, "documents", "doc_id", "source", "text"), "doc_id")
    return mixing.mix_plan(sizes, table(spark, directory, "mix_targets")).where("short").select("mix_id", "source")


def _mix(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    return mixing.drawn_mix(table(spark, directory, "documents", "doc_id", "source", "text"), table(spark, directory, "mix_targets"), "doc_id")


def p7_shares(spark: SparkSession, directory: str) -> DataFrame:
    """Repeats, target and actual shares of the sources of each mix, from the documents drawn."""
    rows = mixing.shares(*_mix(spark, directory))
    return rows.select("mix_id", "source", *[F.round(c, 6).alias(c) for c in ("target_share", "actual_share", "repeats")], "short")


def p7_draw(spark: SparkSession, directory: str) -> DataFrame:
    """The documents drawn for each mix, with their copy and the block of their source."""
    return _mix(spark, directory)[1].select("mix_id", "source", "doc_id", "copy_no", "block_no")


def p7_deviation(spark: SparkSession, directory: str) -> DataFrame:
    """Per mix whether its sources stay within less than one block (but for rounding) of their share all along the sequence."""
    sizes = mixing.sized(table(spark, directory, "documents", "doc_id", "source", "text"), "doc_id")
    rows = mixing.deviations(mixing.mix_plan(sizes, table(spark, directory, "mix_targets")))
    return rows.groupBy("mix_id").agg((F.max("deviation") < 1 + 1e-9).alias("within_one_block"))


def p8_found(spark: SparkSession, directory: str) -> DataFrame:
    """Personal information in the documents: one row per item."""
    return pii.find(table(spark, directory, "documents", "doc_id", "text"), "doc_id").select("doc_id", "pii_type", "begin_pos")


def p8_redacted(spark: SparkSession, directory: str) -> DataFrame:
    """The texts with a typed placeholder in place of each item."""
    return pii.redact(table(spark, directory, "documents", "doc_id", "text"), "doc_id")


_SIZES = r"""
WITH d AS (SELECT doc_id, replace(lower(trim(source)), '-', '_') AS source, coalesce(len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\s\p{Z}\p{L}\p{N}_]')), 0) AS n FROM documents WHERE trim(source) <> ''),
s AS (SELECT source, sum(n) AS tokens FROM d GROUP BY 1),
t AS (SELECT mix_id, replace(lower(trim(source)), '-', '_') AS source, weight / sum(weight) OVER (PARTITION BY mix_id) AS share, max_repeats, total_tokens FROM mix_targets),
p AS (SELECT t.*, share * total_tokens AS target, max_repeats * coalesce(tokens, 0) AS supply, coalesce(tokens, 0) AS tokens FROM t LEFT JOIN s USING (source)),
q AS (SELECT d.*, coalesce(sum(n) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM d),
g AS (SELECT p.mix_id, p.source, p.tokens, p.total_tokens, q.doc_id, q.n, q.place, CAST(ceil((round(least(target, supply), 6) - place) / tokens) AS INT) AS copies
  FROM p JOIN q ON p.source = q.source WHERE place < round(least(target, supply), 6))
"""

QUERIES = {
    "p1_found": p1_found, "p1_chunks": p1_chunks, "p1_checked": p1_checked, "p3_found": p3_found,
    "p5_found": p5_found, "p5_pieces": p5_pieces, "p5_checked": p5_checked,
    "p6_found": p6_found, "p7_found": p7_found, "p7_shares": p7_shares, "p7_draw": p7_draw, "p7_deviation": p7_deviation,
    "p8_found": p8_found, "p8_redacted": p8_redacted,
}
SQL = {
    "p1_found": f"SELECT DISTINCT lecture_id, id AS segment_id FROM transcript_segments WHERE length(trim(text)) > {CAPACITY}",
    "p1_checked": f"""
WITH s AS (SELECT lecture_id, id, coalesce(arg_min(length(trim(text)), ingested_at), 0) AS n FROM transcript_segments GROUP BY 1, 2)
SELECT lecture_id, count(*) AS segments, sum(n) AS characters, true AS within, true AS few FROM s WHERE n <= {CAPACITY} GROUP BY 1""",
    "p3_found": f"""
WITH q AS (SELECT DISTINCT lower(trim(lecture_id)) AS e, id, CAST(round(ts_sec * 1000) AS BIGINT) AS t FROM visual_requests WHERE ts_sec IS NOT NULL),
r AS (SELECT DISTINCT 'segment' AS k, lower(trim(lecture_id)) AS e, id, CAST(round(start_sec * 1000) AS BIGINT) AS t, {SEGMENT_TOLERANCE_MS} AS tol FROM transcript_segments WHERE start_sec IS NOT NULL
  UNION ALL SELECT DISTINCT 'crop', lower(trim(lecture_id)), id, CAST(round(ts_sec * 1000) AS BIGINT), {CROP_TOLERANCE_MS} FROM formula_crops WHERE ts_sec IS NOT NULL),
j AS (SELECT r.k, q.e, q.id AS request_id, r.id AS match_id, row_number() OVER (PARTITION BY r.k, q.e, q.id ORDER BY abs(r.t - q.t), r.t, r.id) AS n FROM q JOIN r ON q.e = r.e AND r.t BETWEEN q.t - r.tol AND q.t + r.tol),
w AS (SELECT lower(trim(lecture_id)) AS e, min(lecture_id) AS lecture_id FROM transcript_segments GROUP BY 1)
SELECT coalesce(lecture_id, e) AS lecture_id, request_id, k AS match_kind, match_id FROM j LEFT JOIN w USING (e) WHERE n = 1""",
    "p5_checked": f"""
WITH c AS (SELECT lecture_id, id, arg_min(segment_ids, ingested_at) AS segment_ids, min(text) AS text FROM lecture_chunks GROUP BY 1, 2),
s AS (SELECT lecture_id, id, arg_min(text, ingested_at) AS t FROM transcript_segments WHERE text <> '' GROUP BY 1, 2),
x AS (SELECT lecture_id, id AS chunk_id, unnest(segment_ids) AS seg, generate_subscripts(segment_ids, 1) AS place FROM c WHERE text IS NULL),
m AS (SELECT x.lecture_id, chunk_id, string_agg(t, chr(10) ORDER BY place) AS content FROM x JOIN s ON s.lecture_id = x.lecture_id AND s.id = seg GROUP BY 1, 2),
a AS (SELECT lecture_id, id AS chunk_id, text AS content FROM c WHERE text IS NOT NULL UNION ALL SELECT * FROM m)
SELECT lecture_id, chunk_id, md5(content) AS content_md5, true AS within FROM a WHERE length(content) > {LIMIT}""",
    "p5_found": f"""
WITH c AS (SELECT lecture_id, id, arg_min(segment_ids, ingested_at) AS segment_ids, min(text) AS text FROM lecture_chunks GROUP BY 1, 2),
s AS (SELECT lecture_id, id, arg_min(length(text), ingested_at) AS n FROM transcript_segments WHERE text <> '' GROUP BY 1, 2),
x AS (SELECT lecture_id, id AS chunk_id, unnest(segment_ids) AS seg FROM c WHERE text IS NULL),
m AS (SELECT x.lecture_id, chunk_id, sum(n) + count(n) - 1 AS n FROM x JOIN s ON s.lecture_id = x.lecture_id AND s.id = seg GROUP BY 1, 2)
SELECT lecture_id, id AS chunk_id FROM c WHERE length(text) > {LIMIT} UNION ALL SELECT lecture_id, chunk_id FROM m WHERE n > {LIMIT}""",
    "p6_found": r"""
WITH raw AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM eval_items),
bare AS (SELECT side, id, regexp_replace(replace(text, '\\', chr(10)), '\\\p{L}+', ' ', 'g') AS t FROM raw WHERE text <> ''),
reads AS (SELECT side, id, unnest([regexp_replace(t, '(\p{L}\p{M}*)[-\x{AD}\x{2010}\x{2011}]\p{Cf}*[^\S\n]*\r?\n\s*(\p{Cf}*\p{L})', '\1\2', 'g'),
  regexp_replace(t, '(\p{L}\p{M}*)[-\x{AD}\x{2010}\x{2011}]\p{Cf}*[^\S\n]*\r?\n\s*(\p{Cf}*\p{L})', '\1 \2', 'g')]) AS t FROM bare),
plain AS (SELECT side, id, replace(lower(strip_accents(regexp_replace(t, '\p{Cf}+', '', 'g'))), 'ß', 'ss') AS t FROM reads),
listed AS (SELECT DISTINCT side, id, regexp_extract_all(regexp_replace(t, '\p{M}+', '', 'g'), '[\p{L}\p{N}]+') AS w FROM plain),
grams AS (SELECT side, id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS g FROM listed WHERE len(w) >= 12)
SELECT DISTINCT i.id AS item_id, d.id AS doc_id FROM grams i JOIN grams d ON i.g = d.g AND i.side = 'i' AND d.side = 'd'""",
    "p7_found": _SIZES + "SELECT mix_id, source FROM p WHERE supply < target",
    "p7_shares": _SIZES
    + """, w AS (SELECT mix_id, source, sum(n * copies) AS drawn FROM g GROUP BY 1, 2)
SELECT p.mix_id, p.source, round(share, 6) AS target_share, round(coalesce(drawn, 0) / sum(coalesce(drawn, 0)) OVER (PARTITION BY p.mix_id), 6) AS actual_share,
  CASE WHEN tokens > 0 THEN round(coalesce(drawn, 0) / tokens, 6) ELSE 0 END AS repeats, supply < target AS short FROM p LEFT JOIN w ON p.mix_id = w.mix_id AND p.source = w.source""",
    "p7_draw": _SIZES
    + """, e AS (SELECT *, unnest(range(0, copies)) AS copy FROM g)
SELECT mix_id, source, doc_id, CAST(copy AS INT) AS copy_no, CAST(floor((copy * tokens + place) / (total_tokens / 4096.0)) AS INT) AS block_no FROM e""",
    "p7_deviation": "SELECT DISTINCT mix_id, true AS within_one_block FROM mix_targets",
}
