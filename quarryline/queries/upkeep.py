"""Upkeep of texts, artifacts and files: repairs, bounds, round trips through folders, what is stale or unused."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import loosejson, tex
from ..functions import text as T
from ..operators import editing, ranking
from ..operators.graphs import HELD_BY
from ..plans.fixpoint import resolve_aliases
from ..plans.grouped import fold_groups
from ..plans.scan import with_position
from ..plans.staging import shared_folder, staged
from ..sources import literature, sinks
from ..sources.tables import table
from . import base
from .base import BLOCK, CHUNK, OBS, SEG, ms


def merged_references(spark: SparkSession, directory: str) -> DataFrame:
    """All that a node refers to, in order, once."""
    n = base.nodes(spark, directory)
    return n.select("lecture_id", "id", F.array_join(T.merged(F.col("derived_from"), F.col("evidence_ids")), "|").alias("names"))


def printable_texts(spark: SparkSession, directory: str) -> DataFrame:
    """Segments' texts without control characters, by their hash."""
    s = base.segments(spark, directory).where("text IS NOT NULL")
    return s.select("lecture_id", "id", F.md5(T.without_controls(F.col("text")).cast("binary")).alias("text_md5"))


def restored_formulas(spark: SparkSession, directory: str) -> DataFrame:
    """Formulas that JSON had read control characters into, restored."""
    damaged = F.col("latex")
    for command, control in (("\\to", "\to"), ("\\frac", "\frac"), ("\\beta", "\beta"), ("\\rho", "\rho"), ("\\varphi", "\varphi"), ("\\theta", "\theta")):
        damaged = F.replace(damaged, F.lit(command), F.lit(control))
    return base.observations(spark, directory).where("latex IS NOT NULL").select("lecture_id", "id", T.restored_commands(damaged).alias("latex"))


def bounded_texts(spark: SparkSession, directory: str) -> DataFrame:
    """Chunks' texts bounded to 500 characters, saying whether that cut them."""
    c = base.chunks(spark, directory).where("text IS NOT NULL")
    return c.select("lecture_id", "id", T.bounded(F.col("text"), 500).alias("b")).select("lecture_id", "id", "b.truncated", F.md5(F.col("b.text").cast("binary")).alias("text_md5"))


def _written(spark: SparkSession, directory: str) -> DataFrame:
    body = F.concat(F.lit('{"title": "'), F.replace(F.replace(F.coalesce("title", F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"}'))
    return base.nodes(spark, directory).select("lecture_id", "id", body.alias("body"))


def parsed_objects(spark: SparkSession, directory: str) -> DataFrame:
    """Titles read from fenced JSON between thoughts."""
    fenced = F.concat(F.lit("<think>{ none }</think>\n```json\n"), "body", F.lit("\n```"))
    return _written(spark, directory).select("lecture_id", "id", F.get_json_object(loosejson.json_unfence(fenced), "$.title").alias("title"))


def cut_objects(spark: SparkSession, directory: str) -> DataFrame:
    """Which JSON texts are cut off when only their first 40 characters arrive."""
    return _written(spark, directory).select("lecture_id", "id", loosejson.json_cut(F.substring("body", 1, 40)).alias("cut"))


def cleanup_verdicts(spark: SparkSession, directory: str) -> DataFrame:
    """Whether the text of a correction may replace its target's."""
    o = base.observations(spark, directory)
    t = o.select("lecture_id", F.col("id").alias("target_observation_id"), F.col("text").alias("source"))
    return o.join(t, ["lecture_id", "target_observation_id"]).select("lecture_id", "id", T.cleanup_verdict(F.col("source"), F.col("text")).alias("verdict"))


def root_topics(spark: SparkSession, directory: str) -> DataFrame:
    """The topmost of the nodes that each node is part of, by way of the smallest parent; the smallest member where that runs in a circle."""
    e = base.edges(spark, directory).where(F.col("relation").isin(*HELD_BY)).select("lecture_id", F.col("src").alias("alias"), F.col("dst").alias("target"))
    return resolve_aliases(e.where("alias <> '' AND target <> ''"), ["lecture_id"]).select("lecture_id", F.col("alias").alias("node"), F.col("canonical").alias("root"))


def best_crops(spark: SparkSession, directory: str) -> DataFrame:
    """The three surest crops of each lecture and minute."""
    c = table(spark, directory, "formula_crops", "lecture_id", "id", "ts_sec", "detector_confidence").where("ts_sec IS NOT NULL AND detector_confidence IS NOT NULL").distinct()
    c = c.withColumn("minute", F.floor(F.col("ts_sec") / 60))
    return ranking.top_per_key(c, ["lecture_id", "minute"], [F.desc("detector_confidence"), F.col("id")], 3).select("lecture_id", "minute", "rank", "id")


def pruned_windows(spark: SparkSession, directory: str) -> DataFrame:
    """The 25 best windows among those with the fewest unresolved observations: few of low confidence, then many in all."""
    o = base.observations(spark, directory).where("window_id IS NOT NULL")
    w = o.groupBy(F.concat_ws("/", "lecture_id", "window_id").alias("window")).agg(F.count_if(F.col("kind") == "unresolved").alias("unresolved"), F.count_if(F.coalesce("confidence", F.lit(0.0)) < 0.8).alias("low"), (-F.count("*")).alias("fewer"))
    return editing.prune(w, "window", ["unresolved"], ["low", "fewer"], 25)


def canonical_sources(spark: SparkSession, directory: str) -> DataFrame:
    """Documents with a language of a closed vocabulary, from ``lang`` or else ``source``."""
    d = table(spark, directory, "documents", "doc_id", "lang", "source")
    d = editing.canonical(d, {"lang": ["source"]}, {"lang": {"en": "en", "de": "de", "fr": "fr", "ru": "ru", "eng": "en", "": "other"}})
    return d.select("doc_id", "lang")


def reindexed_segments(spark: SparkSession, directory: str) -> DataFrame:
    """Segments numbered anew in order of time."""
    s = base.segments(spark, directory).where("s IS NOT NULL").select("lecture_id", "id", "s", "e")
    return with_position(s, ["lecture_id"], "s", ["e", "id"]).select("lecture_id", "id", "pos")


def halved_windows(spark: SparkSession, directory: str) -> DataFrame:
    """Observations of a window halved until no part has more than 400 characters or one row."""
    o = base.observations(spark, directory).where("window_id IS NOT NULL").select("lecture_id", "window_id", "id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))

    def fold(rows: list[dict]) -> list[dict]:
        parts = editing.halves(rows, lambda part: len(part) == 1 or sum(r["n"] for r in part) <= 400)
        return [{"lecture_id": p[0]["lecture_id"], "window_id": p[0]["window_id"], "first_id": p[0]["id"], "rows": len(p), "characters": sum(r["n"] for r in p)} for p in parts]

    return fold_groups(o, ["lecture_id", "window_id"], ["id"], fold, "lecture_id string, window_id string, first_id string, rows int, characters int")


def artifact_windows(spark: SparkSession, directory: str) -> DataFrame:
    """Windows written as JSON artifacts in parts, read back by a declared schema and united per id."""
    c = base.chunks(spark, directory).select("lecture_id", "id", F.posexplode("segment_ids").alias("part", "segment_id"))
    folder = f"{shared_folder(spark)}/artifacts-{uuid.uuid4().hex}"
    c.write.partitionBy("part").json(folder)
    return literature.united_artifacts(spark, folder, "lecture_id string, id string, segment_id string", ["lecture_id", "id"], "segment_id").select("lecture_id", "id", F.array_join("segment_ids", " ").alias("segment_ids"))


def written_lectures(spark: SparkSession, directory: str) -> DataFrame:
    """Characters of the rendered blocks per lecture, read back from the folder they are written to."""
    b = base.blocks(spark, directory).where("lecture_id IS NOT NULL")
    b = b.select("lecture_id", "id", sinks.rendered(F.col("block_type"), F.col("title"), F.col("latex")).alias("tex"))
    folder = f"{shared_folder(spark)}/lectures-{uuid.uuid4().hex}"
    sinks.write_texts(b, folder, "lecture_id", ["id"], "tex")
    lines = spark.read.text(folder)
    return lines.groupBy(F.col("lecture_id").cast("string").alias("lecture_id")).agg((F.sum(F.length("value")) + F.count("*")).alias("characters"))


def unused_images(spark: SparkSession, directory: str) -> DataFrame:
    """Images of crops that no block shows."""
    files = table(spark, directory, "formula_crops", "image_path").where("image_path <> ''").select(F.col("image_path").alias("path")).distinct()
    return sinks.unreferenced(files, table(spark, directory, "linear_blocks", "asset_path").select(F.col("asset_path").alias("path")))


def audit_rows(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes with aliases or dependencies, written as audit rows and read back."""
    n = base.nodes(spark, directory).where("lecture_id IS NOT NULL").select("lecture_id", "id", "derived_from", "aliases")
    folder = f"{shared_folder(spark)}/audit-{uuid.uuid4().hex}"
    sinks.write_audit(n, folder, "lecture_id", "derived_from", "aliases")
    rows = spark.read.schema("id string, derived_from array<string>, aliases array<string>, lecture_id string").json(folder)
    return rows.select("lecture_id", "id", F.coalesce(F.size("derived_from"), F.lit(0)).alias("derived"), F.coalesce(F.size("aliases"), F.lit(0)).alias("aliases"))


def stale_chunks(spark: SparkSession, directory: str) -> DataFrame:
    """Chunks to be done again: those whose text is not as it was when it was cut to 2,000 characters."""
    c = base.chunks(spark, directory).select("lecture_id", "id", sinks.fingerprint(F.col("lecture_id"), F.col("id"), F.col("text")).alias("fingerprint"), "text")
    done = c.select("lecture_id", "id", sinks.fingerprint(F.col("lecture_id"), F.col("id"), F.substring("text", 1, 2000)).alias("fingerprint"))
    return sinks.to_do(c, done, ["lecture_id", "id"]).select("lecture_id", "id", "fingerprint")


def heading_titles(spark: SparkSession, directory: str) -> DataFrame:
    """Titles of nodes with their mathematics between dollars."""
    return base.nodes(spark, directory).where("title <> ''").select("lecture_id", "id", tex.tex_heading("title").alias("title"))


def joined_chunks(spark: SparkSession, directory: str) -> DataFrame:
    """The length of each chunk's text joined to the text of the one before, without what both have."""
    c = staged(with_position(base.chunks(spark, directory).where("s IS NOT NULL AND text IS NOT NULL").select("lecture_id", "id", "s", "text"), ["lecture_id"], "s", ["id"]), "chunks")
    before = c.select("lecture_id", (F.col("pos") + 1).alias("pos"), F.right("text", F.lit(1500)).alias("left"))
    return c.join(before, ["lecture_id", "pos"]).select("lecture_id", "id", F.length(tex.tex_joined("left", F.substring("text", 1, 1500))).alias("characters"))


QUERIES = {f.__name__: f for f in (merged_references, printable_texts, restored_formulas, bounded_texts, parsed_objects, cut_objects, cleanup_verdicts, root_topics, best_crops, pruned_windows, canonical_sources, reindexed_segments, halved_windows, artifact_windows, written_lectures, unused_images, audit_rows, stale_chunks, heading_titles, joined_chunks)}

_UNRESOLVED = "'unresolved'"
_NODE = "n AS (SELECT lecture_id, id, arg_min(derived_from, ingested_at) AS der, arg_min(evidence_ids, ingested_at) AS ev, arg_min(aliases, ingested_at) AS al, min(title) AS title FROM graph_nodes GROUP BY 1, 2)"
_SIGN = r"""list_sort(list_distinct(regexp_extract_all({0}, '\b[A-Za-z]\b'))) AS sy, list_sort(list_distinct(regexp_extract_all({0}, '[0-9]+'))) AS nu,
list_distinct(list_transform(regexp_extract_all({0}, '[A-Za-z][A-Za-z0-9_()]*\s*=\s*-?[A-Za-z][A-Za-z0-9_()]*'), lambda x: regexp_replace(x, '\s+', '', 'g'))) AS eq"""
_ESC = "replace(replace(coalesce(title, ''), '\\', '\\\\'), '\"', '\\\"')"
SQL = {
    "merged_references": f"WITH {_NODE} SELECT lecture_id, id, array_to_string(list_distinct_ordered, '|') AS names FROM (SELECT lecture_id, id, list_filter(x, lambda v, i: list_position(x, v) = i) AS list_distinct_ordered FROM (SELECT lecture_id, id, list_filter(list_concat(coalesce(der, []), coalesce(ev, [])), lambda v: trim(v, ' ') <> '') AS x FROM n))",
    "printable_texts": rf"SELECT lecture_id, id, md5(regexp_replace(text, '[\x00-\x08\x0B-\x1F\x7F]', '', 'g')) AS text_md5 FROM ({SEG}) WHERE text IS NOT NULL",
    "restored_formulas": f"SELECT lecture_id, id, latex FROM ({OBS}) WHERE latex IS NOT NULL",
    "bounded_texts": f"SELECT lecture_id, id, length(text) > 500 AS truncated, md5(substr(text, 1, 500)) AS text_md5 FROM ({CHUNK}) WHERE text IS NOT NULL",
    "parsed_objects": f"WITH {_NODE} SELECT lecture_id, id, coalesce(title, '') AS title FROM n",
    "cut_objects": f"WITH {_NODE} SELECT lecture_id, id, length({_ESC}) + 13 > 40 AS cut FROM n",
    "cleanup_verdicts": rf"""WITH o AS ({OBS}), p AS (SELECT o.lecture_id, o.id, t.text AS a, o.text AS b FROM o JOIN o t ON t.lecture_id = o.lecture_id AND t.id = o.target_observation_id),
x AS (SELECT lecture_id, id, {_SIGN.format("translate(coalesce(a, ''), '−', '-')")} FROM p), y AS (SELECT lecture_id, id, {_SIGN.format("translate(coalesce(b, ''), '−', '-')")} FROM p)
SELECT p.lecture_id, p.id, CASE WHEN trim(coalesce(b, ''), ' ') = '' THEN 'empty' WHEN regexp_matches(b, '(?i)(на доске|лектор|on the board|the lecturer|an der tafel|au tableau|видно ли|can you all see)') THEN 'narration'
WHEN x.nu <> y.nu THEN 'numbers' WHEN len(list_filter(y.sy, lambda v: NOT list_contains(x.sy, v))) > 0 THEN 'new symbols' WHEN len(list_filter(y.eq, lambda v: NOT list_contains(x.eq, v))) > 0 THEN 'new equality' WHEN length(b) > 2 * length(a) THEN 'too long' ELSE 'ok' END AS verdict
FROM p JOIN x ON x.lecture_id = p.lecture_id AND x.id = p.id JOIN y ON y.lecture_id = p.lecture_id AND y.id = p.id""",
    "root_topics": "WITH RECURSIVE l AS (SELECT lecture_id, trim(source) AS a, min(trim(target)) AS t FROM graph_edges WHERE relation IN ('part_of', 'in_section', 'in_topic', 'belongs_to_topic') AND trim(source) <> '' AND trim(target) <> '' AND trim(source) <> trim(target) GROUP BY 1, 2), r AS (SELECT lecture_id, a AS node, t AS v FROM l UNION SELECT r.lecture_id, r.node, l.t FROM r JOIN l ON l.lecture_id = r.lecture_id AND l.a = r.v), o AS (SELECT lecture_id, node FROM r WHERE node = v) SELECT r.lecture_id, r.node, coalesce(min(CASE WHEN l.a IS NULL THEN r.v END), min(CASE WHEN o.node IS NOT NULL THEN r.v END)) AS root FROM r LEFT JOIN l ON l.lecture_id = r.lecture_id AND l.a = r.v LEFT JOIN o ON o.lecture_id = r.lecture_id AND o.node = r.v GROUP BY 1, 2",
    "best_crops": "WITH c AS (SELECT DISTINCT lecture_id, id, ts_sec, detector_confidence, CAST(floor(ts_sec / 60) AS BIGINT) AS minute FROM formula_crops WHERE ts_sec IS NOT NULL AND detector_confidence IS NOT NULL) SELECT lecture_id, minute, CAST(row_number() OVER (PARTITION BY lecture_id, minute ORDER BY detector_confidence DESC, id) AS INT) AS rank, id FROM c QUALIFY rank <= 3",
    "pruned_windows": f'WITH w AS (SELECT concat_ws(chr(47), lecture_id, window_id) AS "window", count(*) FILTER (kind = {_UNRESOLVED}) AS unresolved, count(*) FILTER (coalesce(confidence, 0) < 0.8) AS low, -count(*) AS fewer FROM ({OBS}) WHERE window_id IS NOT NULL GROUP BY 1) SELECT * FROM w WHERE unresolved = (SELECT min(unresolved) FROM w) ORDER BY low, fewer, "window" LIMIT 25',
    "canonical_sources": "SELECT doc_id, CASE lower(trim(CASE WHEN trim(lang, ' ') <> '' THEN lang WHEN trim(source, ' ') <> '' THEN source END, ' ')) WHEN 'en' THEN 'en' WHEN 'de' THEN 'de' WHEN 'fr' THEN 'fr' WHEN 'ru' THEN 'ru' WHEN 'eng' THEN 'en' ELSE 'other' END AS lang FROM documents",
    "reindexed_segments": f"SELECT lecture_id, id, row_number() OVER (PARTITION BY lecture_id ORDER BY {ms('start_sec')}, {ms('end_sec')} NULLS FIRST, id) - 1 AS pos FROM ({SEG}) WHERE start_sec IS NOT NULL",
    "halved_windows": f"""WITH RECURSIVE p AS (SELECT lecture_id, window_id, id, coalesce(length(text), 0) AS n, row_number() OVER (PARTITION BY lecture_id, window_id ORDER BY id) - 1 AS i FROM ({OBS}) WHERE window_id IS NOT NULL),
t AS (SELECT *, sum(n) OVER (PARTITION BY lecture_id, window_id ORDER BY i) AS upto, count(*) OVER (PARTITION BY lecture_id, window_id) AS k FROM p),
c AS (SELECT lecture_id, window_id, list(upto ORDER BY i) AS u, list(id ORDER BY i) AS ids, max(k) AS k FROM t GROUP BY 1, 2),
w AS (SELECT lecture_id, window_id, u, ids, CAST(0 AS BIGINT) AS a, k AS b FROM c UNION ALL SELECT lecture_id, window_id, u, ids, unnest([a, a + (b - a) // 2]), unnest([a + (b - a) // 2, b]) FROM w WHERE b - a > 1 AND u[b] - coalesce(u[a], 0) > 400)
SELECT lecture_id, window_id, ids[a + 1] AS first_id, CAST(b - a AS INT) AS rows, CAST(u[b] - coalesce(u[a], 0) AS INT) AS characters FROM w WHERE b - a = 1 OR u[b] - coalesce(u[a], 0) <= 400""",
    "artifact_windows": f"SELECT lecture_id, id, array_to_string(list_sort(list_distinct(list_filter(segment_ids, lambda x: x IS NOT NULL))), ' ') AS segment_ids FROM ({CHUNK}) WHERE len(segment_ids) > 0",
    "written_lectures": rf"""WITH b AS ({BLOCK}), t AS (SELECT lecture_id, coalesce(latex, '') AS body, block_type, CASE WHEN trim(title, ' ') <> '' THEN '[' || title || ']' ELSE '' END AS head FROM b WHERE lecture_id IS NOT NULL),
x AS (SELECT lecture_id, CASE WHEN block_type = 'equation' THEN '\[' || chr(10) || body || chr(10) || '\]' WHEN block_type IN ('definition', 'theorem', 'lemma', 'proof', 'example', 'remark', 'exercise') THEN '\begin{{' || block_type || '}}' || head || chr(10) || body || chr(10) || '\end{{' || block_type || '}}' ELSE body END AS tex FROM t)
SELECT lecture_id, sum(length(tex) + 1) AS characters FROM x GROUP BY 1""",
    "unused_images": "SELECT DISTINCT image_path AS path FROM formula_crops WHERE image_path <> '' AND NOT EXISTS (SELECT 1 FROM linear_blocks WHERE asset_path = image_path)",
    "audit_rows": f"WITH {_NODE} SELECT lecture_id, id, coalesce(len(der), 0) AS derived, coalesce(len(al), 0) AS aliases FROM n WHERE lecture_id IS NOT NULL AND (len(der) > 0 OR len(al) > 0)",
    "stale_chunks": f"SELECT lecture_id, id, sha256(concat_ws(chr(31), coalesce(lecture_id, chr(0)), coalesce(id, chr(0)), text)) AS fingerprint FROM ({CHUNK}) WHERE length(text) > 2000",
}
