"""Windows, sessions and ordered folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ordered
from ..operators.intervals import covered_periods
from ..plans.chains import runs
from ..plans.scan import neighbours
from . import base
from .base import OBS, SEG, ms

TARGET_MS, OVERLAP_MS, GAP_MS, SPAN_MS = 480_000, 120_000, 60_000, 20_000


def _timed(spark: SparkSession, directory: str) -> DataFrame:
    return base.segments(spark, directory).where("s IS NOT NULL AND e IS NOT NULL AND e > s")


def chunk_windows(spark: SparkSession, directory: str) -> DataFrame:
    """Overlapping windows of at most eight minutes on segment ends."""
    emit = lambda v, a, b: {"first_id": v["id"][a], "last_id": v["id"][b], "start_ms": v["s"][a], "end_ms": v["e"][b], "segments": b - a + 1}
    rows = _timed(spark, directory).select("lecture_id", "id", "s", "e")
    step = ordered.window_step("s", "e", TARGET_MS, OVERLAP_MS)
    return runs(rows, ["lecture_id"], "s", ["e", "id"], ["e", "id"], TARGET_MS, step, emit, "lecture_id string, first_id string, last_id string, start_ms bigint, end_ms bigint, segments bigint")


def gap_sessions(spark: SparkSession, directory: str) -> DataFrame:
    """Sittings of a lecture: runs of segments without a pause of a minute."""
    s = ordered.gap_sessions(_timed(spark, directory).select("lecture_id", "id", "s", "e"), ["lecture_id"], "s", "e", ["e", "id"], GAP_MS)
    return s.groupBy("lecture_id", "session").agg(F.min("s").alias("start_ms"), F.max("e").alias("end_ms"), F.count("*").alias("segments"))


def span_sessions(spark: SparkSession, directory: str) -> DataFrame:
    """Passages of about 20 s: cut at pauses of a second, at sentence ends past the target, and once 1.5 times the target has passed."""
    emit = lambda v, a, b: {"first_id": v["id"][a], "start_ms": v["s"][a], "end_ms": v["e"][b], "segments": b - a + 1}
    rows = _timed(spark, directory).select("lecture_id", "id", "s", "e", F.coalesce(F.rtrim("text").rlike(r"[.!?]$"), F.lit(False)).alias("closes"))
    step = ordered.passage_step("s", "e", "closes", 1000, SPAN_MS)
    return runs(rows, ["lecture_id"], "s", ["e", "id"], ["e", "id", "closes"], 2 * SPAN_MS, step, emit, "lecture_id string, first_id string, start_ms bigint, end_ms bigint, segments bigint")


def count_batches(spark: SparkSession, directory: str) -> DataFrame:
    """Sliding batches of 30 observations, each repeating 10 of the one before."""
    o = base.observations(spark, directory).where("s IS NOT NULL").select("lecture_id", "id", "s")
    b = ordered.count_batches(o, ["lecture_id"], "s", ["id"], 30, 20)
    return b.groupBy("lecture_id", "batch").agg(F.count("*").alias("n"), F.min("s").alias("start_ms"), F.max("s").alias("end_ms"))


def forward_filled_episodes(spark: SparkSession, directory: str) -> DataFrame:
    """Episodes: a transition opens one, and every observation belongs to the last opened."""
    o = base.observations(spark, directory).where("s IS NOT NULL").select("lecture_id", "id", "s", "e", "kind")
    f = ordered.forward_fill(o, ["lecture_id"], "s", ["e", "id"], F.col("kind") == "transition", "episode")
    return f.groupBy("lecture_id", "episode").agg(F.count("*").alias("observations"), F.min("s").alias("start_ms"), F.max("e").alias("end_ms"))


def outline_islands(spark: SparkSession, directory: str) -> DataFrame:
    """Consecutive observations of one kind as sections."""
    o = base.observations(spark, directory).where("s IS NOT NULL").select("lecture_id", "id", "s", "e", "kind")
    p = ordered.with_position(o, ["lecture_id"], "s", ["e", "id"])
    p = ordered.shifted(p, ["lecture_id"], "pos", ["kind"], 1, "before_")
    p = ordered.running(p, ["lecture_id"], "pos", F.when(F.col("kind").eqNullSafe(F.col("before_kind")) & (F.col("pos") > 0), 0).otherwise(1), "sum", "section")
    return p.groupBy("lecture_id", "section").agg(F.min("kind").alias("kind"), F.count("*").alias("n"), F.min("s").alias("start_ms"))


def neighbour_context(spark: SparkSession, directory: str) -> DataFrame:
    """The two observations before and after each."""
    o = base.observations(spark, directory).where("s IS NOT NULL").select("lecture_id", "id", "s", "e")
    p = ordered.with_position(o, ["lecture_id"], "s", ["e", "id"])
    p = neighbours(p, ["lecture_id"], "pos", ["id"], {"b2_": 2, "b1_": 1, "a1_": -1, "a2_": -2})
    return p.select("lecture_id", "id", F.concat_ws(" ", "b2_id", "b1_id", "a1_id", "a2_id").alias("neighbours"))


def merged_speech(spark: SparkSession, directory: str) -> DataFrame:
    """Speech padded by 200 ms on each side, merged."""
    rows = _timed(spark, directory).select("lecture_id", F.greatest(F.lit(0), F.col("s") - 200).alias("s"), (F.col("e") + 200).alias("e"))
    return covered_periods(rows, ["lecture_id"], "s", "e").select("lecture_id", F.col("period_start_ms").alias("start_ms"), F.col("period_end_ms").alias("end_ms"))


def capped_speech(spark: SparkSession, directory: str) -> DataFrame:
    """Speech joined over pauses of up to 800 ms into parts of at most 30 s."""
    rows = _timed(spark, directory).select("lecture_id", "e", F.explode(ordered.piece_starts(F.col("s"), F.col("e"), 30_000)).alias("a"))
    rows = rows.select("lecture_id", F.col("a").alias("s"), F.least("e", F.col("a") + 30_000).alias("e"))
    emit = lambda v, a, b: {"start_ms": v["s"][a], "end_ms": max(v["e"][a : b + 1])}
    return runs(rows, ["lecture_id"], "s", ["e"], ["e"], 60_000, ordered.speech_step("s", "e", 30_000, 800), emit, "lecture_id string, start_ms bigint, end_ms bigint")


def probe_times(spark: SparkSession, directory: str) -> DataFrame:
    """Times to probe each window for changes: every minute, two at least, twelve at most, ends included."""
    c = base.chunks(spark, directory).where("e > s")
    n = F.least(F.lit(12), F.greatest(F.lit(2), F.floor((F.col("e") - F.col("s")) / 60_000).cast("int") + 1))
    at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.floor(F.col("s") + (F.col("e") - F.col("s")) * i / (n - 1)))
    return c.select("lecture_id", "id", F.posexplode(at).alias("n", "at_ms"))


def sample_times(spark: SparkSession, directory: str) -> DataFrame:
    """Six sample times in the middle of equal parts of each window."""
    c = base.chunks(spark, directory).where("e > s")
    at = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.floor(F.col("s") + (F.col("e") - F.col("s")) * (2 * i + 1) / 12))
    return c.select("lecture_id", "id", F.posexplode(at).alias("n", "at_ms"))


QUERIES = {f.__name__: f for f in (chunk_windows, gap_sessions, span_sessions, count_batches, forward_filled_episodes, outline_islands, neighbour_context, merged_speech, capped_speech, probe_times, sample_times)}
_S = f"s AS (SELECT lecture_id, id, {ms('start_sec')} AS s, {ms('end_sec')} AS e, text FROM ({SEG}) WHERE {ms('end_sec')} > {ms('start_sec')})"
_O = f"o AS (SELECT lecture_id, id, {ms('start_sec')} AS s, {ms('end_sec')} AS e, kind FROM ({OBS}) WHERE start_sec IS NOT NULL)"
_BY = "OVER (PARTITION BY lecture_id ORDER BY s, e NULLS FIRST, id"
_P = f"p AS (SELECT *, row_number() {_BY}) - 1 AS i, lag(s) {_BY}) AS ps, lag(e) {_BY}) AS pe, lag(coalesce(regexp_matches(rtrim(text, ' '), '[.!?]$'), false)) {_BY}) AS pc, count(*) OVER (PARTITION BY lecture_id) AS n FROM s)"
SQL = {
    "span_sessions": f"""WITH RECURSIVE {_S}, {_P}, x AS (SELECT a.lecture_id, a.i, min(b.i) AS nx FROM p a JOIN p b ON b.lecture_id = a.lecture_id AND b.i > a.i AND b.ps >= a.s AND b.ps < a.s + {2 * SPAN_MS}
  AND (b.s - b.pe >= 1000 OR (b.pe - a.s >= {SPAN_MS} AND b.pc) OR 2 * (b.pe - a.s) >= {3 * SPAN_MS}) GROUP BY 1, 2),
w AS (SELECT lecture_id, CAST(0 AS BIGINT) AS i FROM p WHERE i = 0 UNION ALL SELECT x.lecture_id, x.nx FROM w JOIN x ON x.lecture_id = w.lecture_id AND x.i = w.i)
SELECT w.lecture_id, a.id AS first_id, a.s AS start_ms, b.e AS end_ms, b.i - a.i + 1 AS segments FROM w JOIN p a ON a.lecture_id = w.lecture_id AND a.i = w.i LEFT JOIN x ON x.lecture_id = w.lecture_id AND x.i = w.i JOIN p b ON b.lecture_id = w.lecture_id AND b.i = coalesce(x.nx, a.n) - 1""",
    "capped_speech": f"""WITH RECURSIVE {_S}, c AS (SELECT lecture_id, e, s AS s0, unnest(range(s, e, 30000)) AS a FROM s), q AS (SELECT lecture_id, a AS s, least(e, a + 30000) AS e FROM c WHERE e - a > 50 OR a = s0),
p AS (SELECT *, row_number() OVER w - 1 AS i, lag(s) OVER w AS ps, count(*) OVER (PARTITION BY lecture_id) AS n FROM q WINDOW w AS (PARTITION BY lecture_id ORDER BY s, e)),
r AS (SELECT a.lecture_id, a.i, a.s AS s0, b.i AS j, b.s, b.e, max(b.e) OVER (PARTITION BY a.lecture_id, a.i ORDER BY b.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach, max(b.e) OVER (PARTITION BY a.lecture_id, a.i) AS top FROM p a JOIN p b ON b.lecture_id = a.lecture_id AND (b.i = a.i OR (b.i > a.i AND b.ps < a.s + 60000))),
x AS (SELECT lecture_id, i, s0, min(j) FILTER (cut) AS nx, coalesce(arg_min(reach, j) FILTER (cut), max(top)) AS e FROM (SELECT *, reach IS NOT NULL AND (s - reach > 800 OR greatest(e, reach) - s0 > 30000) AS cut FROM r) GROUP BY 1, 2, 3),
w AS (SELECT lecture_id, CAST(0 AS BIGINT) AS i FROM p WHERE i = 0 UNION ALL SELECT x.lecture_id, x.nx FROM w JOIN x ON x.lecture_id = w.lecture_id AND x.i = w.i WHERE x.nx IS NOT NULL)
SELECT x.lecture_id, x.s0 AS start_ms, x.e AS end_ms FROM w JOIN x ON x.lecture_id = w.lecture_id AND x.i = w.i""",
    "chunk_windows": f"""WITH RECURSIVE {_S}, p AS (SELECT lecture_id, id, s, e, row_number() {_BY}) - 1 AS i, count(*) OVER (PARTITION BY lecture_id) AS n FROM s),
l AS (SELECT a.lecture_id, a.i, a.n, coalesce(min(b.i), a.n) - 1 AS z FROM p a LEFT JOIN p b ON a.lecture_id = b.lecture_id AND b.i > a.i AND b.e - a.s > {TARGET_MS} GROUP BY 1, 2, 3),
x AS (SELECT l.lecture_id, l.i, l.z, l.n, min(k.i) AS following FROM l JOIN p y ON y.lecture_id = l.lecture_id AND y.i = l.z LEFT JOIN p k ON k.lecture_id = l.lecture_id AND k.i > l.i AND k.i <= l.z + 1 AND (k.i = l.z + 1 OR k.e > y.e - {OVERLAP_MS}) GROUP BY 1, 2, 3, 4),
w AS (SELECT * FROM x WHERE i = 0 UNION ALL SELECT x.* FROM w JOIN x ON x.lecture_id = w.lecture_id AND x.i = w.following WHERE w.z < w.n - 1)
SELECT w.lecture_id, a.id AS first_id, b.id AS last_id, a.s AS start_ms, b.e AS end_ms, w.z - w.i + 1 AS segments FROM w JOIN p a ON a.lecture_id = w.lecture_id AND a.i = w.i JOIN p b ON b.lecture_id = w.lecture_id AND b.i = w.z""",
    "gap_sessions": f"WITH {_S}, r AS (SELECT *, max(e) {_BY} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM s), g AS (SELECT *, sum(CASE WHEN s - r >= {GAP_MS} THEN 1 ELSE 0 END) {_BY} ROWS UNBOUNDED PRECEDING) AS session FROM r) SELECT lecture_id, session, min(s) AS start_ms, max(e) AS end_ms, count(*) AS segments FROM g GROUP BY 1, 2",
    "count_batches": f"WITH {_O}, p AS (SELECT lecture_id, s, row_number() OVER (PARTITION BY lecture_id ORDER BY s, id) - 1 AS pos, count(*) OVER (PARTITION BY lecture_id) AS n FROM o), b AS (SELECT lecture_id, s, unnest(range(greatest(0, CAST(floor((pos - 30) / 20.0) AS BIGINT) + 1), least(CAST(greatest(0, ceil((n - 30) / 20.0)) AS BIGINT), pos // 20) + 1)) AS batch FROM p) SELECT lecture_id, batch, count(*) AS n, min(s) AS start_ms, max(s) AS end_ms FROM b GROUP BY 1, 2",
    "forward_filled_episodes": f"WITH {_O}, f AS (SELECT *, sum(CASE WHEN kind = 'transition' THEN 1 ELSE 0 END) {_BY} ROWS UNBOUNDED PRECEDING) AS episode FROM o) SELECT lecture_id, episode, count(*) AS observations, min(s) AS start_ms, max(e) AS end_ms FROM f GROUP BY 1, 2",
    "outline_islands": f"WITH {_O}, l AS (SELECT *, lag(kind) {_BY}) AS k, row_number() {_BY}) AS n FROM o), f AS (SELECT *, sum(CASE WHEN n > 1 AND kind IS NOT DISTINCT FROM k THEN 0 ELSE 1 END) {_BY} ROWS UNBOUNDED PRECEDING) AS section FROM l) SELECT lecture_id, section, min(kind) AS kind, count(*) AS n, min(s) AS start_ms FROM f GROUP BY 1, 2",
    "neighbour_context": f"WITH {_O} SELECT lecture_id, id, concat_ws(' ', lag(id, 2) {_BY}), lag(id) {_BY}), lead(id) {_BY}), lead(id, 2) {_BY})) AS neighbours FROM o",
    "merged_speech": f"WITH {_S}, t AS (SELECT lecture_id, greatest(0, s - 200) AS s, e + 200 AS e FROM s), r AS (SELECT *, max(e) OVER (PARTITION BY lecture_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM t), g AS (SELECT *, sum(CASE WHEN r IS NULL OR s > r THEN 1 ELSE 0 END) OVER (PARTITION BY lecture_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS n FROM r) SELECT lecture_id, min(s) AS start_ms, max(e) AS end_ms FROM g GROUP BY lecture_id, n",
    "probe_times": f"WITH c AS (SELECT lecture_id, id, {ms('start_sec')} AS s, {ms('end_sec')} AS e FROM ({base.CHUNK})), k AS (SELECT *, least(12, greatest(2, (e - s) // 60000 + 1)) AS k FROM c WHERE e > s), x AS (SELECT *, unnest(range(0, k)) AS n FROM k) SELECT lecture_id, id, n, CAST(floor(s + (e - s) * n / (k - 1)) AS BIGINT) AS at_ms FROM x",
    "sample_times": f"WITH c AS (SELECT lecture_id, id, {ms('start_sec')} AS s, {ms('end_sec')} AS e FROM ({base.CHUNK})), x AS (SELECT *, unnest(range(0, 6)) AS n FROM c WHERE e > s) SELECT lecture_id, id, n, CAST(floor(s + (e - s) * (2 * n + 1) / 12) AS BIGINT) AS at_ms FROM x",
}
