"""Payloads, assembly and checks of notes over the lecture tables. A window is the batch; observations stand for records, their kinds for sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import notes
from ..sources.tables import millis, table
from . import base
from .base import BLOCK, CHUNK, OBS, ms
from .totals import node_times

_W = ["lecture_id", "window_id"]


def _obs(spark: SparkSession, directory: str) -> DataFrame:
    return base.observations(spark, directory).where("window_id IS NOT NULL")


def window_symbols(spark: SparkSession, directory: str) -> DataFrame:
    """The four notations that were introduced last before each window begins, besides its own."""
    o = _obs(spark, directory).where("kind = 'notation'")
    batches = base.chunks(spark, directory).select("lecture_id", F.col("id").alias("batch"), F.col("s").alias("start"))
    found = notes.earlier_symbols(batches, o.select("lecture_id", "id", F.col("s").alias("at")), o.select("lecture_id", F.col("window_id").alias("batch"), "id"), ["lecture_id"], 4)
    return found.select("lecture_id", F.col("batch").alias("window_id"), "id")


def record_symbols(spark: SparkSession, directory: str) -> DataFrame:
    """Formulas of a window's equations that a claim of it holds, two at most; else its last."""
    o = _obs(spark, directory)
    symbols = o.where("kind = 'equation' AND latex IS NOT NULL").select(*_W, T.squeezed(F.col("latex")).alias("symbol"), F.col("id").alias("place"))
    probes = o.where("kind = 'claim'").select(*_W, "id", T.squeezed(F.concat_ws(" ", "text", "latex")).alias("probe"))
    return notes.relevant_symbols(probes, symbols, _W, 2, 1)


def evidence_catalog(spark: SparkSession, directory: str) -> DataFrame:
    """Segments that a window's observations or the window itself name: directly if an observation does."""
    direct = _obs(spark, directory).select(*_W, F.explode("evidence_refs").alias("ref"), F.lit(True).alias("direct"), F.lit("observation").alias("origin"))
    rest = base.chunks(spark, directory).select("lecture_id", F.col("id").alias("window_id"), F.explode("segment_ids").alias("ref"), F.lit(False).alias("direct"), F.lit("window").alias("origin"))
    return notes.first_references([direct, rest], _W)


def boundary_records(spark: SparkSession, directory: str) -> DataFrame:
    """Per window the last two equations and the first two claims, or what lies around its middle."""
    o = _obs(spark, directory).select(*_W, "id", F.col("id").alias("pos"), (F.col("kind") == "equation").alias("of_left"), (F.col("kind") == "claim").alias("of_right"))
    return notes.across_boundary(o, _W, 2)


def timeless_words(spark: SparkSession, directory: str) -> DataFrame:
    """Words of segments without their times."""
    s = table(spark, directory, "transcript_segments", "lecture_id", "id", "words").where("size(words) > 0").distinct()
    return s.select("lecture_id", "id", F.to_json(notes.without_fields("words", ["start_sec", "end_sec"])).alias("words"))


def references_within(spark: SparkSession, directory: str) -> DataFrame:
    """References of an observation to segments of its own window."""
    c = base.chunks(spark, directory).select("lecture_id", F.col("id").alias("window_id"), "segment_ids")
    return _obs(spark, directory).join(c, _W).select("lecture_id", "id", F.array_join(notes.within("segment_ids", "evidence_refs"), " ").alias("refs"))


def local_requests(spark: SparkSession, directory: str) -> DataFrame:
    """Times of the requests of a window that lie in it, or the nearest to its middle."""
    r = table(spark, directory, "visual_requests", "lecture_id", "id", "ts_sec").select("lecture_id", F.regexp_extract("id", "^(window_[0-9]+)", 1).alias("window_id"), millis("ts_sec").alias("t")).where("t IS NOT NULL").distinct()
    r = r.groupBy(*_W).agg(F.array_sort(F.collect_list("t")).alias("times"))
    c = base.chunks(spark, directory).where("s IS NOT NULL AND e IS NOT NULL").select("lecture_id", F.col("id").alias("window_id"), "s", "e")
    return r.join(c, _W).select(*_W, F.array_join(notes.local_or_nearest("times", F.col("s"), F.col("e")).cast("array<string>"), " ").alias("times"))


def concatenated_windows(spark: SparkSession, directory: str) -> DataFrame:
    """References of a window's observations one after another, and their kinds."""
    o = _obs(spark, directory).select(*_W, "id", "evidence_refs", F.array("kind").alias("kinds"))
    rows = notes.concatenated(o, _W, "id", "evidence_refs", "kinds")
    return rows.select(*_W, F.array_join("evidence_refs", " ").alias("refs"), F.array_join("kinds", " ").alias("kinds"))


def outline_coverage(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes per window by its observations, and the observations without any."""
    o = _obs(spark, directory).select("lecture_id", F.col("window_id").alias("section"), F.col("id").alias("place"), F.col("id").alias("episode"))
    n = base.nodes(spark, directory).select("lecture_id", "id", F.explode(F.array_distinct("evidence_ids")).alias("episode")).groupBy("lecture_id", "episode").agg(F.count("*").alias("blocks"))
    return notes.assembled(o, n, ["lecture_id"]).select("lecture_id", "section", "blocks", F.array_join("missing", " ").alias("missing"))


def section_headers(spark: SparkSession, directory: str) -> DataFrame:
    """Observations that open a kind within a window of several."""
    o = _obs(spark, directory).select(*_W, F.col("id").alias("place"), F.col("kind").alias("subsection"))
    return notes.with_headers(o, _W).where("header IS NOT NULL").select(*_W, F.col("place").alias("id"), "header")


def window_anchors(spark: SparkSession, directory: str) -> DataFrame:
    """Windows numbered in order of time."""
    return notes.anchors(base.chunks(spark, directory).select("lecture_id", "id", "s", "e"), ["lecture_id"])


def sampled_offsets(spark: SparkSession, directory: str) -> DataFrame:
    """Offsets to sample around each request: the more, the higher its priority."""
    r = table(spark, directory, "visual_requests", "lecture_id", "id", "priority").where("priority > 0").distinct()
    at = notes.sample_offsets(F.lit(3.0), 4.0 / F.col("priority"), 9)
    return r.select("lecture_id", "id", F.posexplode(at).alias("n", "offset_sec")).withColumn("offset_sec", F.round("offset_sec", 6))


def new_records(spark: SparkSession, directory: str) -> DataFrame:
    """Sure observations as the newly written lines of their window."""
    legible = F.when(F.col("source_status") == "observed", "clear").when(F.col("source_status") == "reconstructed", "partial").otherwise("uncertain")
    o = _obs(spark, directory).select("lecture_id", F.col("window_id").alias("window"), F.col("id").alias("place"), F.coalesce(F.col("confidence") >= 0.6, F.lit(False)).alias("complete"), "text", "latex", legible.alias("legibility"))
    return notes.delta_records(o, ["lecture_id"])


def request_times(spark: SparkSession, directory: str) -> DataFrame:
    """Distinct times of requests per lecture."""
    return notes.distinct_times(table(spark, directory, "visual_requests", "lecture_id", "ts_sec"), ["lecture_id"], "ts_sec").select("lecture_id", "at_ms")


def renamed_titles(spark: SparkSession, directory: str) -> DataFrame:
    """Titles with some names written otherwise."""
    names = [("лемма", "Лемма"), ("lemma", "Lemma"), ("Лемма ", "Л. ")]
    return base.nodes(spark, directory).where("title <> ''").select("lecture_id", "id", notes.renamed(F.col("title"), names).alias("title"))


def reading_candidates(spark: SparkSession, directory: str) -> DataFrame:
    """Readings of observations that others target: their own, up to two of the others', and none."""
    o = base.observations(spark, directory).where("confidence IS NOT NULL")
    d = o.where("target_observation_id IS NOT NULL").select("lecture_id", F.col("target_observation_id").alias("id"), F.expr("cast(regexp_extract(id, '([0-9]+)$', 1) as int)").alias("place"), F.col("text").alias("content"), (F.col("confidence") - 0.5).alias("score"))
    rows = notes.candidate_sets(o.select("lecture_id", "id", F.col("text").alias("content"), "confidence"), d, ["lecture_id"], 4)
    return rows.select("lecture_id", "id", "candidate", F.round("score", 6).alias("score"), "source")


def corrected_records(spark: SparkSession, directory: str) -> DataFrame:
    """Texts under the corrections that name them, and the corrections that do not apply."""
    o = base.observations(spark, directory)
    fixes = o.where("kind = 'correction' AND target_observation_id IS NOT NULL").select("lecture_id", F.col("target_observation_id").alias("block_no"), F.col("text").alias("latex"), "confidence", F.col("id").alias("place"))
    return notes.corrected(o.where("kind <> 'correction'").select("lecture_id", F.col("id").alias("block_no"), F.col("text").alias("latex")), fixes, ["lecture_id"], 0.75)


def patch_verdicts(spark: SparkSession, directory: str) -> DataFrame:
    """Observations that target others as patches of them: what is wrong with them, and what they do."""
    o = base.observations(spark, directory)
    t = o.select("lecture_id", F.col("id").alias("target_observation_id"), F.col("latex").alias("was"), F.col("evidence_refs").alias("near"))
    c = base.chunks(spark, directory).select("lecture_id", F.col("id").alias("window_id"), "segment_ids")
    p = o.join(t, ["lecture_id", "target_observation_id"]).join(c, ["lecture_id", "window_id"])
    action = F.when(F.col("source_status") == "observed", "replace").when(F.col("source_status") == "reconstructed", "keep").otherwise("reject")
    refs = F.coalesce("evidence_refs", F.array().cast("array<string>"))
    fault = notes.transaction_fault(action, F.col("text"), F.col("latex"), F.col("target_observation_id"), refs)
    status = notes.patch_status(action, F.col("was"), F.col("latex"), refs, F.col("segment_ids"), F.coalesce("near", F.array().cast("array<string>")))
    return p.select("lecture_id", "id", fault.alias("fault"), status.alias("status"))


def node_support(spark: SparkSession, directory: str) -> DataFrame:
    """What supports active nodes: a formula counts as seen, a text as heard."""
    n = base.nodes(spark, directory)
    said = F.when(F.col("status") == "active", "uncertain").otherwise(F.col("status"))
    sources = F.array_compact(F.array(F.when(F.col("latex").isNotNull(), "visual"), F.when(F.col("semantic_text").isNotNull(), "transcript")))
    return n.where("status IS NOT NULL").select("lecture_id", "id", notes.support(said, sources).alias("support"))


def unsafe_records(spark: SparkSession, directory: str) -> DataFrame:
    """Observations that a mark of 0.8 or more tells to leave out."""
    o = base.observations(spark, directory)
    ids = F.concat(F.coalesce("evidence_refs", F.array().cast("array<string>")), F.array(F.lit("audit-issue:none"), F.concat(F.lit("audit-suppress:"), F.coalesce(F.col("confidence").cast("string"), F.lit("?")))))
    return o.where(notes.marked_unsafe(ids, ("audit-suppress:", "audit-issue:"))).select("lecture_id", "id")


def board_replacements(spark: SparkSession, directory: str) -> DataFrame:
    """Doubtful observations of a minute with the surest unused crops of that minute, two at most."""
    keys = ["lecture_id", "minute"]
    minute = lambda c: F.floor(F.col(c) / 60).alias("minute")
    crops = table(spark, directory, "formula_crops", "lecture_id", "id", "ts_sec", "detector_confidence", "image_path").where("ts_sec IS NOT NULL").distinct()
    evidence = crops.select("lecture_id", minute("ts_sec"), "id", F.col("image_path").alias("asset"), F.lit("crop").alias("kind"), F.col("detector_confidence").alias("confidence"))
    shown = table(spark, directory, "linear_blocks", "lecture_id", "asset_path").where("asset_path <> ''").distinct().select("lecture_id", F.col("asset_path").alias("asset"))
    used = evidence.select(*keys, "asset").join(shown, ["lecture_id", "asset"], "left_semi")
    doubtful = base.observations(spark, directory).where("s IS NOT NULL AND confidence < 0.8").select("lecture_id", F.floor(F.col("s") / 60_000).alias("minute"), "id", F.col("s").alias("place"))
    return notes.replacements(doubtful, notes.eligible(evidence, used, keys, ("crop",), 0.5), keys, 2)


def speculative_blocks(spark: SparkSession, directory: str) -> DataFrame:
    """Blocks that speak of what was left open."""
    b = base.blocks(spark, directory)
    return notes.demoted(b, "(?i)(второй случай|second case|zweite fall|second cas)", "latex").where("speculative").select("lecture_id", "id")


def node_plan_faults(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes as items of a plan that build on active nodes: what is wrong with them."""
    n = base.nodes(spark, directory)
    cited = F.filter(F.transform("derived_from", lambda x: F.trim(x)), lambda x: x != "")
    items = n.select("lecture_id", F.col("id").alias("place"), F.regexp_replace("kind", "^provisional_", "").alias("kind"), cited.alias("cited"), F.col("latex").isNotNull().alias("is_formula"))
    return notes.plan_faults(items, n.where("status = 'active'").select("lecture_id", "id", "latex"), ["lecture_id"])


def grouped_records(spark: SparkSession, directory: str) -> DataFrame:
    """Observations of a window in groups of neighbours that a node cites together."""
    o = _obs(spark, directory).select(*_W, "id", F.expr("cast(regexp_extract(id, '([0-9]+)$', 1) as int)").alias("n"))
    low = o.groupBy(*_W).agg(F.min("n").alias("low"))
    o = o.join(low, _W).select(*_W, "id", (F.col("n") - F.col("low")).alias("pos"))
    cited = base.nodes(spark, directory).select("lecture_id", F.col("id").alias("block"), F.posexplode("evidence_ids").alias("place", "id"))
    plan = cited.join(o.select(*_W, "id"), ["lecture_id", "id"]).select(*_W, "block", "place", "id")
    return notes.canonical_groups(o, plan, _W)


def chunk_faults(spark: SparkSession, directory: str) -> DataFrame:
    """Ten segments planned per window against those from the second to the thirteenth in order of id."""
    c = base.chunks(spark, directory).where("size(segment_ids) > 2")
    planned = c.select("lecture_id", F.col("id").alias("window_id"), F.posexplode(F.slice("segment_ids", 1, 10)).alias("pos", "id"))
    said = c.select("lecture_id", F.col("id").alias("window_id"), F.posexplode(F.array_sort(F.slice("segment_ids", 2, 12))).alias("place", "id"))
    return notes.block_faults(planned, said, _W)


def surviving_evidence(spark: SparkSession, directory: str) -> DataFrame:
    """What nodes cite of what exists, and whether anything is left."""
    n = base.nodes(spark, directory).select("lecture_id", "id", "evidence_ids")
    rows = notes.surviving(n, "evidence_ids", base.observations(spark, directory).select("lecture_id", "id"), ["lecture_id"])
    return rows.select("lecture_id", "id", F.array_join("evidence_ids", " ").alias("evidence_ids"), "active")


def closed_episodes(spark: SparkSession, directory: str) -> DataFrame:
    """Statuses once open ones, here active topics, are closed."""
    n = base.nodes(spark, directory).select("lecture_id", "id", F.when((F.col("kind") == "topic") & (F.col("status") == "active"), "OPEN").otherwise(F.col("status")).alias("status"))
    return notes.closed(n)


def equation_types(spark: SparkSession, directory: str) -> DataFrame:
    """Equations that hold prose made paragraphs."""
    b = base.blocks(spark, directory).where("block_type = 'equation'")
    return b.select("lecture_id", "id", F.when(T.is_formula(F.col("latex")), "equation").otherwise("paragraph").alias("block_type"))


def section_payloads(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes of each six minutes and the edges among them."""
    n = node_times(spark, directory).where("start_ms IS NOT NULL").select("lecture_id", F.floor(F.col("start_ms") / 360_000).alias("section"), F.col("node_id").alias("id"))
    e = base.edges(spark, directory).select("lecture_id", "edge_id", F.col("src").alias("id"), "dst").join(n, ["lecture_id", "id"]).select("lecture_id", "section", "edge_id", F.col("dst").alias("id"))
    inside = e.join(n, ["lecture_id", "section", "id"]).groupBy("lecture_id", "section").agg(F.count("*").alias("relations"))
    rows = n.groupBy("lecture_id", "section").agg(F.array_join(F.array_sort(F.collect_list("id")), " ").alias("nodes"))
    return rows.join(inside, ["lecture_id", "section"], "left").select("lecture_id", "section", "nodes", F.coalesce("relations", F.lit(0)).alias("relations"))


def routed_alternatives(spark: SparkSession, directory: str) -> DataFrame:
    """Alternatives and suppressed nodes with the six minutes of what they derive from, or the last of the lecture."""
    n = base.nodes(spark, directory)
    placed = node_times(spark, directory).where("start_ms IS NOT NULL").select("lecture_id", F.col("node_id").alias("id"), F.floor(F.col("start_ms") / 360_000).alias("section"))
    aside = n.where("status <> 'active'").select("lecture_id", "id", F.coalesce("derived_from", F.array().cast("array<string>")).alias("related"))
    return notes.routed(aside, placed, ["lecture_id"])


def promoted_formulas(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes whose formula is just that of one observation of the lecture."""
    n = base.nodes(spark, directory).select("lecture_id", "id", T.squeezed(F.col("latex")).alias("content"))
    o = base.observations(spark, directory).select("lecture_id", "id", T.squeezed(F.col("latex")).alias("content"))
    return notes.unique_matches(n, o, ["lecture_id"]).select("lecture_id", "id", F.col("match").alias("observation_id"))


QUERIES = {f.__name__: f for f in (routed_alternatives, promoted_formulas, window_symbols, record_symbols, evidence_catalog, boundary_records, timeless_words, references_within, local_requests, concatenated_windows, outline_coverage, section_headers, window_anchors, sampled_offsets, new_records, request_times, renamed_titles, reading_candidates, corrected_records, patch_verdicts, node_support, unsafe_records, board_replacements, speculative_blocks, node_plan_faults, grouped_records, chunk_faults, surviving_evidence, closed_episodes, equation_types, section_payloads)}

_O = f"o AS ({OBS}), r AS (SELECT lecture_id, id, arg_min(evidence_refs, ingested_at) AS refs FROM observations GROUP BY 1, 2)"
_N = "n AS (SELECT lecture_id, id, min(kind) AS kind, min(status) AS status, min(title) AS title, min(latex) AS latex, min(semantic_text) AS semantic_text, arg_min(evidence_ids, ingested_at) AS ev, arg_min(derived_from, ingested_at) AS der FROM graph_nodes GROUP BY 1, 2)"
_SQUEEZE = r"lower(regexp_replace(coalesce({0}, ''), '\s+', '', 'g'))"
_ONCE = "list_filter({0}, lambda v, i: list_position({0}, v) = i)"
SQL = {
    "routed_alternatives": f"WITH {_N}, t AS (SELECT lecture_id, node_id AS id, CAST(floor(min({ms('start_sec')}) / 360000) AS BIGINT) AS section FROM (SELECT DISTINCT lecture_id, id AS node_id, unnest(evidence_ids) AS id FROM graph_nodes) x JOIN (SELECT DISTINCT lecture_id, id, start_sec FROM observations WHERE start_sec IS NOT NULL) o USING (lecture_id, id) GROUP BY 1, 2), a AS (SELECT lecture_id, id, der FROM n WHERE status <> 'active'), r AS (SELECT DISTINCT e.lecture_id, e.id, section FROM (SELECT lecture_id, id, unnest(der) AS d FROM a) e JOIN t ON t.lecture_id = e.lecture_id AND t.id = e.d) SELECT * FROM r UNION ALL SELECT a.lecture_id, a.id, l.section FROM a JOIN (SELECT lecture_id, max(section) AS section FROM t GROUP BY 1) l USING (lecture_id) ANTI JOIN r ON r.lecture_id = a.lecture_id AND r.id = a.id",
    "promoted_formulas": f"WITH {_O}, {_N}, k AS (SELECT lecture_id, {_SQUEEZE.format('latex')} AS c, min(id) AS id, count(DISTINCT id) AS k FROM o GROUP BY 1, 2) SELECT n.lecture_id, n.id, k.id AS observation_id FROM n JOIN k ON k.lecture_id = n.lecture_id AND k.c = {_SQUEEZE.format('n.latex')} WHERE k = 1 AND c <> ''",
    "window_symbols": f"WITH {_O}, c AS ({CHUNK}), k AS (SELECT lecture_id, window_id, id, {ms('start_sec')} AS t FROM o WHERE kind = 'notation'), p AS (SELECT c.lecture_id, c.id AS window_id, k.id, row_number() OVER (PARTITION BY c.lecture_id, c.id ORDER BY k.t DESC, k.id DESC) AS n FROM c JOIN k ON k.lecture_id = c.lecture_id AND k.t <= {ms('c.start_sec')} AND k.window_id IS DISTINCT FROM c.id) SELECT lecture_id, window_id, id FROM p WHERE n <= 4",
    "record_symbols": f"WITH {_O}, s AS (SELECT lecture_id, window_id, id AS place, {_SQUEEZE.format('latex')} AS symbol FROM o WHERE kind = 'equation' AND latex IS NOT NULL), p AS (SELECT lecture_id, window_id, id, {_SQUEEZE.format('concat_ws(chr(32), text, latex)')} AS probe FROM o WHERE kind = 'claim'), j AS (SELECT p.lecture_id, p.window_id, p.id, symbol, place, symbol <> '' AND contains(probe, symbol) AS hit FROM p JOIN s ON s.lecture_id = p.lecture_id AND s.window_id = p.window_id), a AS (SELECT *, bool_or(hit) OVER (PARTITION BY lecture_id, window_id, id) AS has FROM j), q AS (SELECT *, row_number() OVER (PARTITION BY lecture_id, window_id, id ORDER BY place DESC, symbol DESC) AS n FROM a WHERE hit OR NOT has) SELECT lecture_id, window_id, id, symbol FROM q WHERE n <= CASE WHEN has THEN 2 ELSE 1 END",
    "evidence_catalog": f"WITH {_O}, a AS (SELECT DISTINCT o.lecture_id, window_id, trim(unnest(refs)) AS ref FROM o JOIN r USING (lecture_id, id)), b AS (SELECT DISTINCT lecture_id, id AS window_id, trim(unnest(segment_ids)) AS ref FROM ({CHUNK})) SELECT *, true AS direct, 'observation' AS origin FROM a WHERE ref <> '' UNION ALL SELECT *, false, 'window' FROM b ANTI JOIN a USING (lecture_id, window_id, ref) WHERE ref <> ''",
    "boundary_records": f"WITH {_O}, p AS (SELECT lecture_id, window_id, id, coalesce(kind = 'equation', false) AS l, coalesce(kind = 'claim', false) AS r FROM o), q AS (SELECT *, bool_or(l OR r) OVER w AS has, sum(CAST(l AS INT)) OVER (PARTITION BY lecture_id, window_id ORDER BY id DESC) AS nl, sum(CAST(r AS INT)) OVER (PARTITION BY lecture_id, window_id ORDER BY id) AS nr, row_number() OVER (PARTITION BY lecture_id, window_id ORDER BY id) - 1 AS i, count(*) OVER w // 2 AS m FROM p WINDOW w AS (PARTITION BY lecture_id, window_id)) SELECT lecture_id, window_id, id FROM q WHERE l AND nl <= 2 OR r AND nr <= 2 OR NOT has AND i BETWEEN m - 2 AND m + 1",
    "timeless_words": "SELECT DISTINCT lecture_id, id, CAST(to_json(list_transform(words, lambda x: {'text': x.text})) AS VARCHAR) AS words FROM transcript_segments WHERE len(words) > 0",
    "references_within": f"WITH {_O}, c AS ({CHUNK}), x AS (SELECT o.lecture_id, o.id, list_filter(refs, lambda v: list_contains(segment_ids, v)) AS l FROM o JOIN r USING (lecture_id, id) JOIN c ON c.lecture_id = o.lecture_id AND c.id = o.window_id) SELECT lecture_id, id, array_to_string({_ONCE.format('l')}, ' ') AS refs FROM x",
    "local_requests": f"WITH r AS (SELECT DISTINCT lecture_id, regexp_extract(id, '^(window_[0-9]+)', 1) AS window_id, {ms('ts_sec')} AS t FROM visual_requests WHERE ts_sec IS NOT NULL), c AS (SELECT lecture_id, id AS window_id, {ms('start_sec')} AS s, {ms('end_sec')} AS e FROM ({CHUNK})), j AS (SELECT r.*, s, e, t BETWEEN s AND e AS inside FROM r JOIN c USING (lecture_id, window_id) WHERE s IS NOT NULL AND e IS NOT NULL) SELECT lecture_id, window_id, coalesce(string_agg(t, ' ' ORDER BY t) FILTER (inside), CAST(first(t ORDER BY abs(t - (s + e) / 2.0), t) AS VARCHAR)) AS times FROM j GROUP BY 1, 2",
    "concatenated_windows": f"WITH {_O}, x AS (SELECT lecture_id, window_id, flatten(list(coalesce(refs, []) ORDER BY id)) AS a, list(kind ORDER BY id) AS k FROM o JOIN r USING (lecture_id, id) GROUP BY 1, 2) SELECT lecture_id, window_id, array_to_string(a, ' ') AS refs, array_to_string({_ONCE.format('k')}, ' ') AS kinds FROM x",
    "outline_coverage": f"WITH {_O}, {_N}, b AS (SELECT lecture_id, episode, count(*) AS blocks FROM (SELECT DISTINCT lecture_id, id, unnest(ev) AS episode FROM n) GROUP BY 1, 2) SELECT o.lecture_id, window_id AS section, coalesce(sum(blocks), 0) AS blocks, coalesce(string_agg(o.id, ' ' ORDER BY o.id) FILTER (blocks IS NULL), '') AS missing FROM o LEFT JOIN b ON b.lecture_id = o.lecture_id AND b.episode = o.id GROUP BY 1, 2",
    "section_headers": f"WITH {_O}, f AS (SELECT lecture_id, window_id, kind, min(id) AS id, count(*) OVER (PARTITION BY lecture_id, window_id) AS k FROM o GROUP BY 1, 2, 3) SELECT lecture_id, window_id, id, kind AS header FROM f WHERE k > 1",
    "window_anchors": f"SELECT lecture_id, row_number() OVER (PARTITION BY lecture_id ORDER BY {ms('start_sec')}, {ms('end_sec')} NULLS FIRST, id) - 1 AS place, id FROM ({CHUNK}) WHERE start_sec IS NOT NULL",
    "sampled_offsets": "WITH q AS (SELECT DISTINCT lecture_id, id, priority, greatest(3, least(CAST(floor(6.0 / (4.0 / priority)) AS INT) + 1, 9)) AS k FROM visual_requests WHERE priority > 0), m AS (SELECT *, greatest(3, k - (1 - k % 2)) AS c FROM q), x AS (SELECT *, unnest(range(0, c)) AS n FROM m) SELECT lecture_id, id, CAST(n AS INT) AS n, round(-3.0 + n * (6.0 / (c - 1)), 6) AS offset_sec FROM x",
    "new_records": f"WITH {_O} SELECT lecture_id, 'obs_' || window_id || '_' || lpad(CAST(row_number() OVER (PARTITION BY lecture_id, window_id ORDER BY id) - 1 AS VARCHAR), 3, '0') AS id, CASE WHEN trim(latex, ' ') <> '' THEN 'equation' ELSE 'remark' END AS kind, trim(text, ' ') AS text, CASE WHEN trim(latex, ' ') <> '' THEN trim(latex, ' ') END AS latex, CAST(CASE source_status WHEN 'observed' THEN 0.9 WHEN 'reconstructed' THEN 0.65 ELSE 0.4 END AS DOUBLE) AS confidence FROM o WHERE confidence >= 0.6",
    "request_times": "SELECT DISTINCT lecture_id, CAST(round_even(greatest(0.0, ts_sec) * 1000, 0) AS BIGINT) AS at_ms FROM visual_requests WHERE ts_sec IS NOT NULL",
    "renamed_titles": f"WITH {_N} SELECT lecture_id, id, replace(replace(replace(title, 'лемма', 'Лемма'), 'lemma', 'Lemma'), 'Лемма ', 'Л. ') AS title FROM n WHERE title <> ''",
    "reading_candidates": f"""WITH {_O}, s AS (SELECT * FROM o WHERE confidence IS NOT NULL), d AS (SELECT s.lecture_id, s.target_observation_id AS id, CAST(regexp_extract(s.id, '([0-9]+)$', 1) AS INT) AS place, s.text, s.confidence - 0.5 AS score, t.text IS NOT DISTINCT FROM s.text AS same FROM s JOIN s t ON t.lecture_id = s.lecture_id AND t.id = s.target_observation_id),
m AS (SELECT lecture_id, id, max(score) AS up FROM d WHERE same GROUP BY 1, 2), w AS (SELECT lecture_id, id, text, min(place) AS place, arg_min(score, place) AS score FROM d WHERE NOT same GROUP BY 1, 2, 3), k AS (SELECT *, row_number() OVER (PARTITION BY lecture_id, id ORDER BY place) AS n FROM w)
SELECT s.lecture_id, s.id, s.id || ':source' AS candidate, round(greatest(2 * confidence - 1, coalesce(up, 2 * confidence - 1)), 6) AS score, 'source' AS source FROM s LEFT JOIN m ON m.lecture_id = s.lecture_id AND m.id = s.id
UNION ALL SELECT lecture_id, id, id || ':model' || place, round(score, 6), 'model' FROM k WHERE n <= 2 UNION ALL SELECT lecture_id, id, id || ':null', round(-0.15 - 0.7 * confidence, 6), 'null' FROM s""",
    "corrected_records": f"""WITH {_O}, b AS (SELECT lecture_id, id, text FROM o WHERE kind <> 'correction'), j AS (SELECT f.lecture_id, f.target_observation_id AS block_no, f.text, f.id AS place, CASE WHEN b.id IS NULL THEN 'no such block' WHEN NOT coalesce(f.confidence >= 0.75, false) THEN 'not sure enough' WHEN trim(coalesce(f.text, ''), ' ') = '' THEN 'empty' WHEN trim(f.text, ' ') IS NOT DISTINCT FROM trim(b.text, ' ') THEN 'same' ELSE 'applied' END AS outcome
  FROM o f LEFT JOIN b ON b.lecture_id = f.lecture_id AND b.id = f.target_observation_id WHERE f.kind = 'correction' AND f.target_observation_id IS NOT NULL), a AS (SELECT lecture_id, block_no, arg_max(text, place) AS t, count(*) AS k FROM j WHERE outcome = 'applied' GROUP BY 1, 2)
SELECT b.lecture_id, b.id AS block_no, coalesce(a.t, b.text) AS latex, coalesce(k, 0) AS fixes, CAST(NULL AS VARCHAR) AS outcome FROM b LEFT JOIN a ON a.lecture_id = b.lecture_id AND a.block_no = b.id UNION ALL SELECT lecture_id, block_no, text, 0, outcome FROM j WHERE outcome NOT IN ('applied', 'same')""",
    "patch_verdicts": f"""WITH {_O}, p AS (SELECT o.lecture_id, o.id, CASE o.source_status WHEN 'observed' THEN 'replace' WHEN 'reconstructed' THEN 'keep' ELSE 'reject' END AS action, o.text, o.latex, o.target_observation_id AS reason, coalesce(r.refs, []) AS refs, t.latex AS was, coalesce(q.refs, []) AS near, c.segment_ids FROM o JOIN r ON r.lecture_id = o.lecture_id AND r.id = o.id JOIN o t ON t.lecture_id = o.lecture_id AND t.id = o.target_observation_id JOIN r q ON q.lecture_id = t.lecture_id AND q.id = t.id JOIN ({CHUNK}) c ON c.lecture_id = o.lecture_id AND c.id = o.window_id)
SELECT lecture_id, id, CASE WHEN action IN ('keep', 'replace') AND text IS NULL THEN 'text missing' WHEN action = 'keep' AND latex IS NOT NULL THEN 'formula with keep' WHEN action <> 'keep' AND trim(coalesce(reason, ''), ' ') = '' THEN 'reason missing' WHEN action <> 'keep' AND len(refs) = 0 THEN 'references missing' WHEN action = 'reject' AND (text IS NOT NULL OR latex IS NOT NULL) THEN 'content with reject' END AS fault,
CASE WHEN action = 'keep' THEN 'kept' WHEN len(list_filter(refs, lambda v: NOT list_contains(segment_ids, v))) > 0 OR NOT list_has_any(refs, near) THEN 'unresolved' WHEN action = 'reject' THEN 'rejected' WHEN coalesce(trim(was, ' ') <> '' AND trim(latex, ' ') = '', false) THEN 'unresolved' ELSE 'replaced' END AS status FROM p""",
    "node_support": f"WITH {_N} SELECT lecture_id, id, CASE WHEN status <> 'active' THEN status WHEN latex IS NOT NULL AND semantic_text IS NOT NULL THEN 'combined' WHEN latex IS NOT NULL THEN 'visual' WHEN semantic_text IS NOT NULL THEN 'transcript' ELSE 'uncertain' END AS support FROM n WHERE status IS NOT NULL",
    "unsafe_records": f"WITH {_O} SELECT lecture_id, id FROM o WHERE confidence >= 0.8",
    "board_replacements": f"""WITH {_O}, f AS (SELECT DISTINCT lecture_id, id, ts_sec, detector_confidence, image_path FROM formula_crops WHERE ts_sec IS NOT NULL), k AS (SELECT *, CAST(floor(ts_sec / 60) AS BIGINT) AS minute FROM f WHERE image_path <> '' AND detector_confidence >= 0.5 AND NOT EXISTS (SELECT 1 FROM linear_blocks b WHERE b.lecture_id = f.lecture_id AND b.asset_path = f.image_path)),
a AS (SELECT *, row_number() OVER (PARTITION BY lecture_id, minute ORDER BY detector_confidence DESC, id) AS n FROM k), d AS (SELECT lecture_id, id, CAST(floor({ms('start_sec')} / 60000) AS BIGINT) AS minute, {ms('start_sec')} AS s FROM o WHERE start_sec IS NOT NULL AND confidence < 0.8), u AS (SELECT *, row_number() OVER (PARTITION BY lecture_id, minute ORDER BY s, id) AS n FROM d)
SELECT u.lecture_id, u.minute, u.id AS block_id, a.image_path AS asset FROM u LEFT JOIN a ON a.lecture_id = u.lecture_id AND a.minute = u.minute AND a.n = u.n AND a.n <= 2""",
    "speculative_blocks": f"SELECT lecture_id, id FROM ({BLOCK}) WHERE regexp_matches(latex, '(?i)(второй случай|second case|zweite fall|second cas)')",
    "node_plan_faults": f"WITH {_N}, i AS (SELECT lecture_id, id AS place, regexp_replace(kind, '^provisional_', '') AS kind, latex IS NOT NULL AS is_formula, list_filter(list_transform(der, lambda x: trim(x, ' ')), lambda x: x <> '') AS cited FROM n), e AS (SELECT lecture_id, place, kind, is_formula, unnest(CASE WHEN len(cited) > 0 THEN cited ELSE [NULL] END) AS id FROM i), k AS (SELECT e.*, CASE WHEN a.id IS NOT NULL THEN trim(coalesce(a.latex, ''), ' ') END AS l FROM e LEFT JOIN n a ON a.lecture_id = e.lecture_id AND a.id = e.id AND a.status = 'active'), f AS (SELECT lecture_id, place, CASE WHEN l IS NULL AND id IS NOT NULL THEN 'cites what is not there' WHEN NOT is_formula AND kind IN ('correction', 'retraction', 'transition', 'unresolved') THEN 'no statement' WHEN is_formula AND coalesce(l, '') = '' THEN 'no formula' END AS fault FROM k) SELECT lecture_id, place, min(fault) AS fault FROM f WHERE fault IS NOT NULL GROUP BY 1, 2",
    "grouped_records": f"""WITH {_O}, {_N}, x AS (SELECT lecture_id, window_id, id, CAST(regexp_extract(id, '([0-9]+)$', 1) AS INT) AS k FROM o), p AS (SELECT lecture_id, window_id, id, k - min(k) OVER (PARTITION BY lecture_id, window_id) AS pos FROM x),
c AS (SELECT lecture_id, id AS block, unnest(ev) AS id, generate_subscripts(ev, 1) AS place FROM n), m AS (SELECT p.*, block, place FROM c JOIN p ON p.lecture_id = c.lecture_id AND p.id = c.id), u AS (SELECT * FROM m QUALIFY count(*) OVER (PARTITION BY lecture_id, window_id, id) = 1),
b AS (SELECT *, lag(pos) OVER (PARTITION BY lecture_id, window_id, block ORDER BY place) AS b FROM u), g AS (SELECT *, bool_and(coalesce(b < pos, true)) OVER (PARTITION BY lecture_id, window_id, block) AS fine FROM b), j AS (SELECT lecture_id, window_id, id FROM g WHERE fine AND pos = b + 1)
SELECT p.lecture_id, p.window_id, p.id, pos, sum(CASE WHEN j.id IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY p.lecture_id, p.window_id ORDER BY pos ROWS UNBOUNDED PRECEDING) - 1 AS group_no FROM p LEFT JOIN j ON j.lecture_id = p.lecture_id AND j.window_id = p.window_id AND j.id = p.id""",
    "chunk_faults": f"""WITH c AS (SELECT lecture_id, id AS window_id, segment_ids[1:10] AS a, list_sort(segment_ids[2:13]) AS b FROM ({CHUNK}) WHERE len(segment_ids) > 2), p AS (SELECT lecture_id, window_id, unnest(a) AS id, generate_subscripts(a, 1) AS pos FROM c), s AS (SELECT lecture_id, window_id, id, min(place) AS first FROM (SELECT lecture_id, window_id, unnest(b) AS id, generate_subscripts(b, 1) AS place FROM c) GROUP BY 1, 2, 3),
j AS (SELECT p.*, first, max(first) OVER (PARTITION BY p.lecture_id, p.window_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM p LEFT JOIN s ON s.lecture_id = p.lecture_id AND s.window_id = p.window_id AND s.id = p.id), f AS (SELECT lecture_id, window_id, count(*) AS k FROM s ANTI JOIN p USING (lecture_id, window_id, id) GROUP BY 1, 2)
SELECT j.lecture_id, j.window_id, coalesce(any_value(k), 0) AS foreign, count(*) FILTER (first IS NULL) AS missing, bool_and(first IS NOT NULL AND coalesce(first > before, true)) AS in_order FROM j LEFT JOIN f ON f.lecture_id = j.lecture_id AND f.window_id = j.window_id GROUP BY 1, 2""",
    "surviving_evidence": f"WITH {_N}, x AS (SELECT lecture_id, id, unnest(ev) AS e, generate_subscripts(ev, 1) AS i FROM n), k AS (SELECT x.* FROM x SEMI JOIN observations o ON o.lecture_id = x.lecture_id AND o.id = x.e), l AS (SELECT lecture_id, id, string_agg(e, ' ' ORDER BY i) AS s FROM k GROUP BY 1, 2) SELECT n.lecture_id, n.id, coalesce(s, '') AS evidence_ids, s IS NOT NULL AS active FROM n LEFT JOIN l ON l.lecture_id = n.lecture_id AND l.id = n.id",
    "closed_episodes": f"WITH {_N} SELECT lecture_id, id, CASE WHEN kind = 'topic' AND status = 'active' THEN 'closed' ELSE status END AS status FROM n",
    "equation_types": rf"SELECT lecture_id, id, CASE WHEN trim(latex, ' ') <> '' AND NOT regexp_matches(latex, '\$|\\\[|\\\]') AND NOT regexp_matches(regexp_replace(latex, '\\text\{{[^{{}}]*\}}', '', 'g'), '[А-Яа-яЁё]') THEN 'equation' ELSE 'paragraph' END AS block_type FROM ({BLOCK}) WHERE block_type = 'equation'",
    "section_payloads": f"WITH t AS (SELECT lecture_id, node_id AS id, CAST(floor(min({ms('start_sec')}) / 360000) AS BIGINT) AS section FROM (SELECT DISTINCT lecture_id, id AS node_id, unnest(evidence_ids) AS id FROM graph_nodes) x JOIN (SELECT DISTINCT lecture_id, id, start_sec FROM observations WHERE start_sec IS NOT NULL) o USING (lecture_id, id) GROUP BY 1, 2), e AS (SELECT DISTINCT edge_id, lecture_id, trim(source) AS a, trim(target) AS b FROM graph_edges), k AS (SELECT x.lecture_id, x.section, count(*) AS k FROM e JOIN t x ON x.lecture_id = e.lecture_id AND x.id = e.a JOIN t y ON y.lecture_id = e.lecture_id AND y.id = e.b AND y.section = x.section GROUP BY 1, 2) SELECT t.lecture_id, t.section, string_agg(t.id, ' ' ORDER BY t.id) AS nodes, coalesce(any_value(k), 0) AS relations FROM t LEFT JOIN k ON k.lecture_id = t.lecture_id AND k.section = t.section GROUP BY 1, 2",
}
