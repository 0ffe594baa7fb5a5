"""Text scalars over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from . import base
from .base import BLOCK, NODE, OBS, SEG


def rule_requests(spark: SparkSession, directory: str) -> DataFrame:
    """The first rule that a segment's text matches, and the middle of the segment."""
    s = base.segments(spark, directory)
    pick = lambda i: F.coalesce(*[F.when(F.col("text").rlike(r[0]), F.lit(r[i])) for r in T.BOARD_RULES])
    return s.select("lecture_id", F.col("id").alias("segment_id"), pick(1).alias("reason"), pick(2).alias("priority"), F.floor((F.col("s") + F.col("e")) / 2).alias("at_ms")).where("reason IS NOT NULL")


def correction_signals(spark: SparkSession, directory: str) -> DataFrame:
    """Segments whose words announce a correction."""
    s = base.segments(spark, directory)
    return s.where(F.col("text").rlike(T.CORRECTION)).select("lecture_id", F.col("id").alias("segment_id"))


def normal_texts(spark: SparkSession, directory: str) -> DataFrame:
    """Observations in normal forms: squeezed, collapsed, and the number of distinct tokens."""
    o = base.observations(spark, directory)
    return o.select("lecture_id", "id", T.squeezed(F.col("latex")).alias("latex_key"), T.collapsed(F.col("text")).alias("text_key"), F.size(T.tokens(F.col("text"))).alias("n_tokens"))


def jaccard_targets(spark: SparkSession, directory: str) -> DataFrame:
    """How alike the texts of a correcting observation and of its target are."""
    o = base.observations(spark, directory)
    t = o.select("lecture_id", F.col("id").alias("target_observation_id"), F.col("text").alias("other"))
    joined = o.where("target_observation_id IS NOT NULL").join(t, ["lecture_id", "target_observation_id"])
    return joined.select("lecture_id", "id", F.round(T.jaccard(T.tokens(F.col("text")), T.tokens(F.col("other"))), 6).alias("jaccard"))


def clock_times(spark: SparkSession, directory: str) -> DataFrame:
    """Start times of segments as clock texts."""
    s = base.segments(spark, directory).where("s >= 0")
    return s.select("lecture_id", "id", T.clock(F.col("s") / 1000.0).alias("clock"))


def symbol_sets(spark: SparkSession, directory: str) -> DataFrame:
    """LaTeX symbols of observations."""
    o = base.observations(spark, directory)
    return o.select("lecture_id", "id", F.array_join(F.array_sort(T.symbols(F.col("latex"))), " ").alias("symbols"))


def node_sentences(spark: SparkSession, directory: str) -> DataFrame:
    """Title and sentences of a node, once each, without narration."""
    n = base.nodes(spark, directory)
    units = F.filter(T.merged(F.array("title"), T.sentences(F.col("semantic_text"))), lambda x: ~x.rlike(T.NARRATION))
    return n.select("lecture_id", "id", F.posexplode(units).alias("unit_no", "unit"))


def signature_sets(spark: SparkSession, directory: str) -> DataFrame:
    """Numbers and symbols in the texts of nodes, and whether the title could stand for the text."""
    n = base.nodes(spark, directory)
    s = T.signature(F.col("semantic_text"))
    return n.select("lecture_id", "id", F.array_join(s["symbols"], " ").alias("symbols"), F.array_join(s["numbers"], " ").alias("numbers"), T.cleanup_verdict(F.col("semantic_text"), F.col("title")).alias("verdict"))


def tex_balance(spark: SparkSession, directory: str) -> DataFrame:
    """Blocks whose math delimiters do not pair up."""
    b = base.blocks(spark, directory)
    dollars, round_, square = T.balanced(F.col("latex"))
    return b.where(~(dollars & round_ & square)).select("lecture_id", "id", dollars.alias("dollars"), round_.alias("parentheses"), square.alias("brackets"))


def safe_ids(spark: SparkSession, directory: str) -> DataFrame:
    """Node ids as file names, prefixed with the lecture."""
    return base.nodes(spark, directory).select("lecture_id", "id", F.concat_ws("_", "lecture_id", T.safe_id(F.col("id"))).alias("safe_id"))


def content_hashes(spark: SparkSession, directory: str) -> DataFrame:
    """Hash of a block's canonical content."""
    parts = [F.coalesce(c, F.lit("")) for c in ("block_type", "title", "latex", "caption")]
    return base.blocks(spark, directory).select("lecture_id", "id", F.sha2(F.concat_ws("\x1f", *parts), 256).alias("digest"))


_case = lambda i: "CASE " + " ".join(f"WHEN regexp_matches(text, '{r[0].replace('(?iu)', '(?i)')}') THEN {repr(r[i])}" for r in T.BOARD_RULES) + " END"
_RU = lambda p: p.replace("(?iu)", "(?i)").replace("'", "''")
_tok = r"list_distinct(regexp_extract_all(lower(coalesce({}, '')), '[\p{{L}}\p{{N}}_\\]+'))"
QUERIES = {f.__name__: f for f in (rule_requests, correction_signals, normal_texts, jaccard_targets, clock_times, symbol_sets, node_sentences, signature_sets, tex_balance, safe_ids, content_hashes)}
_NARRATION = "(?i)(на доске|лектор|on the board|the lecturer|an der tafel|au tableau|видно ли|can you all see)"
_SETS = r"""list_sort(list_distinct(list_filter(regexp_extract_all(translate(coalesce({0}, ''), '−', '-'), '[\p{{L}}\p{{M}}\p{{Nd}}_]+'), lambda v: regexp_full_match(v, '[A-Za-z]')))) AS "{1}s", list_sort(list_distinct(regexp_extract_all(translate(coalesce({0}, ''), '−', '-'), '[0-9]+'))) AS {1}n,
list_distinct(list_transform(regexp_extract_all(translate(coalesce({0}, ''), '−', '-'), '[A-Za-z][A-Za-z0-9_()]*\s*=\s*-?[A-Za-z][A-Za-z0-9_()]*'), lambda x: regexp_replace(x, '\s+', '', 'g'))) AS {1}e"""
SQL = {
    "node_sentences": rf"""WITH n AS (SELECT DISTINCT lecture_id, id, title, semantic_text FROM graph_nodes),
x AS (SELECT lecture_id, id, list_filter(list_concat([title], coalesce(list_filter(string_split(regexp_replace(semantic_text, '([.!?])\s+([A-ZА-ЯЁ])', '\1' || chr(30) || '\2', 'g'), chr(30)), lambda v: trim(v, ' ') <> ''), [])), lambda v: trim(v, ' ') <> '') AS l FROM n),
y AS (SELECT lecture_id, id, list_filter(list_filter(l, lambda v, i: list_position(l, v) = i), lambda v: NOT regexp_matches(v, '{_NARRATION}')) AS l FROM x)
SELECT lecture_id, id, CAST(generate_subscripts(l, 1) - 1 AS INT) AS unit_no, unnest(l) AS unit FROM y""",
    "signature_sets": rf"""WITH n AS (SELECT DISTINCT lecture_id, id, title, semantic_text FROM graph_nodes), x AS (SELECT *, {_SETS.format('semantic_text', 'a')}, {_SETS.format('title', 'b')} FROM n)
SELECT lecture_id, id, array_to_string("as", ' ') AS symbols, array_to_string(an, ' ') AS numbers, CASE WHEN trim(coalesce(title, ''), ' ') = '' THEN 'empty' WHEN regexp_matches(title, '{_NARRATION}') THEN 'narration' WHEN an <> bn THEN 'numbers'
WHEN len(list_filter(bs, lambda v: NOT list_contains("as", v))) > 0 THEN 'new symbols' WHEN len(list_filter(be, lambda v: NOT list_contains(ae, v))) > 0 THEN 'new equality' WHEN length(title) > 2 * length(semantic_text) THEN 'too long' ELSE 'ok' END AS verdict FROM x""",
    "rule_requests": f"WITH s AS ({SEG}) SELECT lecture_id, id AS segment_id, {_case(1)} AS reason, {_case(2)} AS priority, CAST(floor(({base.ms('start_sec')} + {base.ms('end_sec')}) / 2) AS BIGINT) AS at_ms FROM s WHERE reason IS NOT NULL",
    "correction_signals": f"WITH s AS ({SEG}) SELECT lecture_id, id AS segment_id FROM s WHERE regexp_matches(text, '{_RU(T.CORRECTION)}')",
    "normal_texts": rf"WITH o AS ({OBS}) SELECT lecture_id, id, lower(regexp_replace(coalesce(latex, ''), '\s+', '', 'g')) AS latex_key, lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS text_key, len({_tok.format('text')}) AS n_tokens FROM o",
    "jaccard_targets": f"WITH o AS ({OBS}), j AS (SELECT a.lecture_id, a.id, {_tok.format('a.text')} AS x, {_tok.format('b.text')} AS y FROM o a JOIN o b ON a.lecture_id = b.lecture_id AND a.target_observation_id = b.id) SELECT lecture_id, id, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))), 6) END AS jaccard FROM j",
    "clock_times": f"WITH s AS ({SEG}), m AS (SELECT lecture_id, id, {base.ms('start_sec')} AS m FROM s WHERE start_sec >= 0) SELECT lecture_id, id, CASE WHEN m >= 3600000 THEN printf('%02d:', m // 3600000) ELSE '' END || printf('%02d:%02d.%03d', m // 60000 % 60, m // 1000 % 60, m % 1000) AS clock FROM m",
    "symbol_sets": rf"WITH o AS ({OBS}) SELECT lecture_id, id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(coalesce(latex, ''), '\\[A-Za-z]+|[A-Za-z]')), lambda x: x NOT IN ('\text', '\left', '\right', '\quad', '\begin', '\end'))), ' ') AS symbols FROM o",
    "tex_balance": rf"WITH b AS ({BLOCK}), c AS (SELECT lecture_id, id, (len(regexp_extract_all(latex, '\$')) - len(regexp_extract_all(latex, '\\\$'))) % 2 = 0 AS dollars, len(regexp_extract_all(latex, '\\\(')) = len(regexp_extract_all(latex, '\\\)')) AS parentheses, len(regexp_extract_all(latex, '\\\[')) = len(regexp_extract_all(latex, '\\\]')) AS brackets FROM b) SELECT * FROM c WHERE NOT (dollars AND parentheses AND brackets)",
    "safe_ids": f"WITH n AS ({NODE}), s AS (SELECT lecture_id, id, regexp_replace(regexp_replace(id, '[^A-Za-z0-9_.-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g') AS s FROM n) SELECT lecture_id, id, lecture_id || '_' || CASE WHEN s = '' THEN 'request' ELSE s END AS safe_id FROM s",
    "content_hashes": f"WITH b AS ({BLOCK}) SELECT lecture_id, id, sha256(concat_ws(chr(31), coalesce(block_type, ''), coalesce(title, ''), coalesce(latex, ''), coalesce(caption, ''))) AS digest FROM b",
}
