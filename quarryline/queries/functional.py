"""Functions that run in Python, batch by batch, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, likeness, tex
from ..functions.loosejson import json_unfence
from ..plans.grouped import fold_groups
from ..sources.tables import table
from . import base
from .base import OBS, SEG, ms


def escaped_blocks(spark: SparkSession, directory: str) -> DataFrame:
    """Titles of nodes escaped for TeX outside mathematics."""
    n = base.nodes(spark, directory).where("title <> ''")
    return n.select("lecture_id", "id", tex.tex_escape_mixed("title").alias("title"))


def laid_out_formulas(spark: SparkSession, directory: str) -> DataFrame:
    """LaTeX of blocks with glyphs as commands and long displays laid out."""
    b = base.blocks(spark, directory).where("latex IS NOT NULL")
    return b.select("lecture_id", "id", tex.layout(tex.math_glyphs("latex")).alias("latex"))


def formula_gate(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes whose LaTeX has lost signs of the LaTeX of their evidence, by the evidence they cover best."""
    n = base.nodes(spark, directory).where("latex IS NOT NULL").select("lecture_id", "id", F.col("latex").alias("written"), F.explode("evidence_ids").alias("e"))
    o = base.observations(spark, directory).where("latex IS NOT NULL").select("lecture_id", F.col("id").alias("e"), "latex")
    pairs = n.join(o, ["lecture_id", "e"]).withColumn("c", likeness.formula_coverage("latex", "written")).where("c.coverage >= 0.55 AND size(c.lost) > 0")
    best = pairs.groupBy("lecture_id", "id").agg(F.max_by(F.struct("e", "c"), F.struct("c.coverage", "e")).alias("b"))
    return best.select("lecture_id", "id", F.col("b.e").alias("evidence_id"), F.round("b.c.coverage", 6).alias("coverage"), F.array_join("b.c.lost", " ").alias("lost"))


def target_likeness(spark: SparkSession, directory: str) -> DataFrame:
    """Likeness of a correcting observation's text to that of its target."""
    o = base.observations(spark, directory)
    t = o.select("lecture_id", F.col("id").alias("target_observation_id"), F.col("text").alias("other"))
    return o.join(t, ["lecture_id", "target_observation_id"]).select("lecture_id", "id", F.round(likeness.text_ratio("text", "other"), 6).alias("ratio"))


def event_properties(spark: SparkSession, directory: str) -> DataFrame:
    """Events' JSON properties, freed of fences, parsed by schema."""
    e = table(spark, directory, "events", "event_id", "props")
    fenced = F.concat(F.lit("```json\n"), "props", F.lit("\n```"))
    return e.select("event_id", F.from_json(json_unfence(fenced), "k bigint")["k"].alias("k"))


_HOTWORDS = ["spectrum", "isometry", "adjoint operator", "compact set", "projector"]


def hotword_echoes(spark: SparkSession, directory: str) -> DataFrame:
    """Segments that repeat the recogniser's hotwords, as every tenth is made to here, with a full stop."""
    s = base.segments(spark, directory).where("text IS NOT NULL")
    heard = F.when(F.endswith("id", F.lit("0")), F.lit(", ".join(_HOTWORDS) + ".")).otherwise(F.col("text"))
    return s.where(likeness.echo_of(_HOTWORDS)(heard)).select("lecture_id", "id")


def kept_states(spark: SparkSession, directory: str) -> DataFrame:
    """Observations of a window after which its confidence has changed by a half in all and 20 s have passed, the first, and a changed tail."""
    o = base.observations(spark, directory).where("s IS NOT NULL AND confidence IS NOT NULL").select("lecture_id", "window_id", "s", "id", "confidence")

    def fold(rows: list[dict]) -> list[dict]:
        changes = [0.0, *(abs(b["confidence"] - a["confidence"]) for a, b in zip(rows, rows[1:]))]
        kept = arrays.distinct_states(changes, [r["s"] for r in rows], 0.5, 20_000)
        return [{k: rows[i][k] for k in ("lecture_id", "window_id", "id")} for i in kept]

    return fold_groups(o, ["lecture_id", "window_id"], ["s", "id"], fold, "lecture_id string, window_id string, id string")


QUERIES = {f.__name__: f for f in (hotword_echoes, kept_states, escaped_blocks, laid_out_formulas, formula_gate, target_likeness, event_properties)}
_ESCAPE = "replace({0}, chr(92), chr(1))"
for _c in "&%$#_{}":
    _ESCAPE = f"replace({_ESCAPE}, '{_c.replace('{', '{{').replace('}', '}}')}', chr(92) || '{_c.replace('{', '{{').replace('}', '}}')}')"
_ESCAPE = f"replace(replace(replace({_ESCAPE}, '~', '\\textasciitilde{{{{}}}}'), '^', '\\textasciicircum{{{{}}}}'), chr(1), '\\textbackslash{{{{}}}}')"
SQL = {
    "hotword_echoes": f"SELECT lecture_id, id FROM ({SEG}) WHERE text IS NOT NULL AND ends_with(id, '0')",
    "kept_states": f"""WITH RECURSIVE p AS (SELECT lecture_id, window_id, id, {ms('start_sec')} AS t, row_number() OVER w AS i, abs(confidence - lag(confidence) OVER w) AS c, count(*) OVER (PARTITION BY lecture_id, window_id) AS n FROM ({OBS}) WHERE start_sec IS NOT NULL AND confidence IS NOT NULL WINDOW w AS (PARTITION BY lecture_id, window_id ORDER BY {ms('start_sec')}, id)),
r AS (SELECT lecture_id, window_id, id, i, n, CAST(0 AS DOUBLE) AS since, t AS last, true AS kept FROM p WHERE i = 1 UNION ALL
  SELECT p.lecture_id, p.window_id, p.id, p.i, p.n, CASE WHEN since + c >= 0.5 AND t - last >= 20000 THEN 0 ELSE since + c END, CASE WHEN since + c >= 0.5 AND t - last >= 20000 THEN t ELSE last END, since + c >= 0.5 AND t - last >= 20000 FROM r JOIN p ON p.lecture_id = r.lecture_id AND p.window_id = r.window_id AND p.i = r.i + 1)
SELECT lecture_id, window_id, id FROM r WHERE kept OR (i = n AND since >= 0.25)""",
    "event_properties": "SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events",
    "escaped_blocks": f"""WITH n AS (SELECT DISTINCT lecture_id, id, title, string_split(title, '$') AS p FROM graph_nodes WHERE title <> '')
SELECT lecture_id, id, CASE WHEN len(p) % 2 = 0 THEN {_ESCAPE.format('title')} ELSE array_to_string(list_transform(p, lambda x, i: CASE WHEN i % 2 = 1 THEN {_ESCAPE.format('x')} ELSE x END), '$') END AS title FROM n""",
}
