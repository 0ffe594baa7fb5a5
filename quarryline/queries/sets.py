"""Set operations, duplicates, consensus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import sets
from ..plans.fixpoint import resolve_aliases
from ..sources.tables import table
from . import base
from .base import NODE


def reconciled(spark: SparkSession, directory: str) -> DataFrame:
    """Observations of one kind that tell of one event, merged."""
    return sets.reconcile(base.observations(spark, directory), ["lecture_id", "kind"]).select("lecture_id", "id", "canonical_id", F.col("s").alias("start_ms"), F.col("e").alias("end_ms"))


def resolved_targets(spark: SparkSession, directory: str) -> DataFrame:
    """Where the chain of targets from each observation ends."""
    o = base.observations(spark, directory).select("lecture_id", F.col("id").alias("alias"), F.col("target_observation_id").alias("target"))
    return resolve_aliases(o, ["lecture_id"]).select("lecture_id", F.col("alias").alias("observation_id"), "canonical")


def exact_blocks(spark: SparkSession, directory: str) -> DataFrame:
    """Blocks of a lecture with the same type, title and body, and the one that stands for each; figures are protected."""
    b = base.blocks(spark, directory)
    content = F.concat_ws("\x1f", *[T.collapsed(F.col(c)) for c in ("block_type", "title", "latex", "caption")])
    kept = sets.exact_duplicates(b, ["lecture_id"], "id", content, F.col("asset_path").isNotNull(), F.length("latex") >= 80)
    return kept.select("lecture_id", "id", "kept_id")


def uncovered_observations(spark: SparkSession, directory: str) -> DataFrame:
    """Required observations that no block covers through a shared segment."""
    required = base.observations(spark, directory).where("kind IN ('definition', 'theorem', 'claim', 'proof_step', 'equation', 'example', 'remark', 'correction') AND length(trim(text)) > 0")
    cited = base.blocks(spark, directory).select("lecture_id", F.explode("source_segment_ids").alias("seg")).distinct()
    covered = required.select("lecture_id", "id", F.explode("evidence_refs").alias("seg")).join(cited, ["lecture_id", "seg"], "left_semi").select("lecture_id", "id")
    return required.select("lecture_id", "id").exceptAll(covered.distinct()).select("lecture_id", F.col("id").alias("observation_id"))


def _states(spark: SparkSession, directory: str) -> DataFrame:
    """Two states of a lecture's nodes: all deliveries, and those with active status."""
    n = base.nodes(spark, directory).select("lecture_id", "id", "kind", F.coalesce("semantic_text", F.lit("")).alias("body"), "status")
    first = n.select(F.lit(1).alias("state_id"), "lecture_id", "id", "kind", "body")
    second = n.where("status = 'active'").select(F.lit(2).alias("state_id"), "lecture_id", "id", F.regexp_replace("kind", "^provisional_remark$", "provisional_claim").alias("kind"), "body")
    return first.unionByName(second)


def consensus_nodes(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes on which both states agree."""
    return sets.consensus(_states(spark, directory), ["lecture_id", "id"], ["kind", "body"]).select("lecture_id", "id", "kind")


def divergent_nodes(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes on which the states differ."""
    return sets.divergent(_states(spark, directory), ["lecture_id", "id"], ["kind", "body"])


def valid_edges(spark: SparkSession, directory: str) -> DataFrame:
    """The first edge of each (source, target, relation) whose ends exist, without loops."""
    ids = base.nodes(spark, directory).select("lecture_id", "id")
    e = base.edges(spark, directory).where("src <> dst").groupBy("lecture_id", "src", "dst", "relation").agg(F.min("edge_id").alias("edge_id"))
    e = e.join(ids.withColumnRenamed("id", "src"), ["lecture_id", "src"], "left_semi").join(ids.withColumnRenamed("id", "dst"), ["lecture_id", "dst"], "left_semi")
    return e.select("edge_id", "lecture_id", "src", "dst", "relation")


def repeated_documents(spark: SparkSession, directory: str) -> DataFrame:
    """Document texts that occur more than once: how often, and the smallest id."""
    d = table(spark, directory, "documents", "doc_id", "text")
    return d.groupBy(F.md5("text").alias("digest")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1 AND digest IS NOT NULL")


_S2 = f"s AS (SELECT 1 AS state_id, lecture_id, id, kind, coalesce(semantic_text, '') AS body FROM ({NODE}) UNION ALL SELECT 2, lecture_id, id, regexp_replace(kind, '^provisional_remark$', 'provisional_claim'), coalesce(semantic_text, '') FROM ({NODE}) WHERE status = 'active')"
_KEY = r"concat_ws(chr(31), " + ", ".join(rf"lower(trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g')))" for c in ("block_type", "title", "latex", "caption")) + ")"
QUERIES = {f.__name__: f for f in (reconciled, resolved_targets, exact_blocks, uncovered_observations, consensus_nodes, divergent_nodes, valid_edges, repeated_documents)}
SQL = {
    "resolved_targets": "WITH RECURSIVE l AS (SELECT lecture_id, id AS a, min(target_observation_id) AS t FROM observations WHERE target_observation_id IS NOT NULL AND target_observation_id <> id GROUP BY 1, 2), w AS (SELECT lecture_id, a, t, 1 AS d FROM l UNION ALL SELECT w.lecture_id, w.a, l.t, d + 1 FROM w JOIN l ON l.lecture_id = w.lecture_id AND l.a = w.t WHERE d < 60) SELECT lecture_id, a AS observation_id, arg_max(t, d) AS canonical FROM w GROUP BY 1, 2",
    "exact_blocks": f"WITH b AS (SELECT DISTINCT lecture_id, id, block_type, title, latex, caption, asset_path IS NOT NULL AS p FROM linear_blocks), k AS (SELECT *, {_KEY} AS k, coalesce(length(latex) >= 80, false) AS l FROM b), f AS (SELECT *, row_number() OVER (PARTITION BY lecture_id, k ORDER BY id) = 1 OR p AS h FROM k WHERE l) SELECT lecture_id, id, last_value(CASE WHEN h THEN id END IGNORE NULLS) OVER (PARTITION BY lecture_id, k ORDER BY id ROWS UNBOUNDED PRECEDING) AS kept_id FROM f UNION ALL SELECT lecture_id, id, id FROM k WHERE NOT l",
    "uncovered_observations": "WITH r AS (SELECT DISTINCT lecture_id, id FROM observations WHERE kind IN ('definition', 'theorem', 'claim', 'proof_step', 'equation', 'example', 'remark', 'correction') AND length(trim(text)) > 0), c AS (SELECT DISTINCT lecture_id, unnest(source_segment_ids) AS seg FROM linear_blocks), o AS (SELECT lecture_id, id, unnest(evidence_refs) AS seg FROM observations) SELECT lecture_id, id AS observation_id FROM r EXCEPT SELECT o.lecture_id, o.id FROM o JOIN c USING (lecture_id, seg)",
    "consensus_nodes": f"WITH {_S2} SELECT lecture_id, id, kind FROM s GROUP BY lecture_id, id, kind, body HAVING count(DISTINCT state_id) = 2",
    "divergent_nodes": f"WITH {_S2} SELECT lecture_id, id, count(DISTINCT (kind, body)) AS versions, count(DISTINCT state_id) AS states FROM s GROUP BY 1, 2 HAVING versions > 1 OR states < 2",
    "valid_edges": "WITH n AS (SELECT DISTINCT lecture_id, id FROM graph_nodes), e AS (SELECT min(edge_id) AS edge_id, lecture_id, trim(source) AS src, trim(target) AS dst, relation FROM graph_edges WHERE trim(source) <> trim(target) GROUP BY 2, 3, 4, 5) SELECT e.* FROM e SEMI JOIN n a ON a.lecture_id = e.lecture_id AND a.id = e.src SEMI JOIN n b ON b.lecture_id = e.lecture_id AND b.id = e.dst",
    "repeated_documents": "SELECT md5(text) AS digest, count(*) AS copies, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
}
