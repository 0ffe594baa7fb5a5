"""Graph queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graphs
from ..operators.joins import asof_join
from ..plans.staging import staged
from . import base
from .sets import _S2, consensus_nodes
from .totals import node_times

_L = ["lecture_id"]


def _pairs(spark: SparkSession, directory: str) -> DataFrame:
    return graphs.dependency_pairs(base.nodes(spark, directory), base.edges(spark, directory), _L)


def dependency_pairs(spark: SparkSession, directory: str) -> DataFrame:
    """Which node depends on which."""
    return _pairs(spark, directory)


def unresolved_closure(spark: SparkSession, directory: str) -> DataFrame:
    """Active nodes that depend on an unresolved one through active nodes."""
    n = base.nodes(spark, directory)
    bad = n.where("kind = 'provisional_unresolved'").select("lecture_id", F.col("id").alias("node"))
    open_ = n.where("status = 'active' AND kind <> 'provisional_unresolved'").select("lecture_id", F.col("id").alias("node"))
    return graphs.propagate(bad, open_, staged(_pairs(spark, directory), "pairs"), _L)


def proof_support(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes that support a suppressed claim, directly or not."""
    seeds = base.nodes(spark, directory).where("kind = 'claim' AND status = 'suppressed'").select("lecture_id", F.col("id").alias("node"))
    return graphs.support_of(seeds, base.edges(spark, directory), _L)


def proof_components(spark: SparkSession, directory: str) -> DataFrame:
    """Connected proofs, claims and proof steps over leads_to, supports and uses."""
    return graphs.chain_components(base.nodes(spark, directory), base.edges(spark, directory), _L, ("leads_to", "supports", "uses"), ("proof", "claim", "provisional_proof_step", "provisional_claim"))


def topic_votes(spark: SparkSession, directory: str) -> DataFrame:
    """Topics of nodes: by the topic that contains them, else by up to eight rounds of weighted votes of neighbours."""
    n, e = base.nodes(spark, directory), base.edges(spark, directory)
    topics = n.where("kind = 'topic'").select("lecture_id", F.col("id").alias("topic"))
    return graphs.spread_topics(graphs.explicit_members(n, e, topics, _L), n, e, _L, topics)


def consensus_closure(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes on which both states agree and that depend, however far, on no node that is lost."""
    kept = consensus_nodes(spark, directory).select("lecture_id", F.col("id").alias("node"))
    needs = base.nodes(spark, directory).select("lecture_id", F.col("id").alias("src"), F.explode("derived_from").alias("dst")).withColumn("dst", F.trim("dst")).where("dst <> ''")
    needs = staged(needs.join(kept.withColumnRenamed("node", "src"), ["lecture_id", "src"], "left_semi").select("lecture_id", "src", "dst"), "needs")
    lost = needs.select("lecture_id", F.col("dst").alias("node")).distinct().join(kept, ["lecture_id", "node"], "left_anti")
    gone = graphs.propagate(lost, kept, needs, _L)
    return kept.join(gone, ["lecture_id", "node"], "left_anti")


def _timed(spark: SparkSession, directory: str) -> DataFrame:
    n = base.nodes(spark, directory).select("lecture_id", F.col("id").alias("node"))
    own = node_times(spark, directory).select("lecture_id", F.col("node_id").alias("node"), F.col("start_ms").alias("t"))
    return graphs.earliest_times(n.join(own, ["lecture_id", "node"], "left"), staged(_pairs(spark, directory), "pairs"), _L)


def effective_times(spark: SparkSession, directory: str) -> DataFrame:
    """The time of each node: of its evidence, else of what it depends on."""
    return _timed(spark, directory)


def section_assignment(spark: SparkSession, directory: str) -> DataFrame:
    """The last topic that starts at or before each node."""
    t = node_times(spark, directory).select("lecture_id", F.col("node_id").alias("id"), "start_ms")
    n = base.nodes(spark, directory).select("lecture_id", "id", "kind").join(t, ["lecture_id", "id"])
    topics = n.where("kind = 'topic'").select("lecture_id", F.col("start_ms").alias("at"), F.col("id").alias("topic"))
    return asof_join(n.where("kind <> 'topic'").select("lecture_id", "id", "start_ms"), topics, _L, "start_ms", "at", "topic", "section").select("lecture_id", "id", F.coalesce("section", F.lit("prelude")).alias("section"))


def section_order(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes of each section, a tenth of an hour, with what they depend on first."""
    n = _timed(spark, directory).where("t IS NOT NULL").withColumn("section", F.floor(F.col("t") / 360_000))
    pairs = _pairs(spark, directory).join(n.select("lecture_id", F.col("node").alias("src"), "section"), ["lecture_id", "src"])
    return graphs.ordered_sections(n, pairs, ["lecture_id", "section"])


_G = """n AS (SELECT DISTINCT lecture_id, id, kind, status FROM graph_nodes), e AS (SELECT DISTINCT edge_id, lecture_id, trim(source) AS src, trim(target) AS dst, relation FROM graph_edges),
d0 AS (SELECT lecture_id, id AS src, trim(unnest(derived_from)) AS dst FROM graph_nodes UNION SELECT lecture_id, src, dst FROM e WHERE relation IN ('supported_by', 'follows_from', 'derived_from', 'based_on', 'about', 'refines', 'specialization_of')
  UNION SELECT e.lecture_id, src, dst FROM e SEMI JOIN n ON n.lecture_id = e.lecture_id AND n.id = e.src AND n.kind IN ('proof', 'proof_step', 'equation', 'claim') WHERE relation IN ('uses', 'uses_result') UNION SELECT lecture_id, dst, src FROM e WHERE relation = 'leads_to'),
d AS (SELECT DISTINCT d0.* FROM d0 SEMI JOIN n a ON a.lecture_id = d0.lecture_id AND a.id = d0.src SEMI JOIN n b ON b.lecture_id = d0.lecture_id AND b.id = d0.dst)"""
_T = f"t AS (SELECT lecture_id, node_id AS id, min({base.ms('start_sec')}) AS t FROM (SELECT DISTINCT lecture_id, id AS node_id, unnest(evidence_ids) AS id FROM graph_nodes) x JOIN (SELECT DISTINCT lecture_id, id, start_sec FROM observations) o USING (lecture_id, id) GROUP BY 1, 2)"


def _topic_rounds(rounds: int = 8) -> str:
    """Rounds of votes written out one after another."""
    weigh = "CASE WHEN relation IN ('refines', 'about') THEN 3.0 WHEN relation IN ('proved_by', 'has_proof_step') THEN 2.5 WHEN relation IN ('supports', 'supported_by') THEN 2.0 WHEN relation IN ('uses', 'leads_to') THEN 1.5 WHEN relation IN ('follows_from', 'derived_from', 'based_on', 'specializes', 'specialization_of', 'defined_on', 'concerns', 'yields', 'introduces', 'denotes_convergence_in', 'proof_step_of', 'uses_result', 'belongs_to_topic', 'reused_in') THEN 1.0 END"
    parts = [
        f"""WITH {_G}, w AS (SELECT lecture_id, src, dst, CAST({weigh} AS DOUBLE) AS w FROM e SEMI JOIN n a ON a.lecture_id = e.lecture_id AND a.id = e.src SEMI JOIN n b ON b.lecture_id = e.lecture_id AND b.id = e.dst WHERE {weigh} IS NOT NULL),
l AS (SELECT * FROM w UNION ALL SELECT lecture_id, dst, src, w FROM w),
m AS (SELECT lecture_id, dst AS node, src AS topic FROM e WHERE relation IN ('contains', 'contains_node', 'has_part') UNION SELECT lecture_id, src, dst FROM e WHERE relation IN ('part_of', 'in_section', 'in_topic', 'belongs_to_topic')),
k0 AS MATERIALIZED (SELECT m.*, 0 AS round FROM m SEMI JOIN n a ON a.lecture_id = m.lecture_id AND a.id = m.node SEMI JOIN n b ON b.lecture_id = m.lecture_id AND b.id = m.topic AND b.kind = 'topic')"""
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"""k{i} AS MATERIALIZED (SELECT * FROM k{i - 1} UNION ALL SELECT lecture_id, node, topic, {i} FROM (
  SELECT k.lecture_id, l.dst AS node, k.topic, sum(l.w) AS s FROM k{i - 1} k JOIN l ON l.lecture_id = k.lecture_id AND l.src = k.node GROUP BY 1, 2, 3) v
  SEMI JOIN n ON n.lecture_id = v.lecture_id AND n.id = v.node AND n.kind <> 'topic' ANTI JOIN k{i - 1} o ON o.lecture_id = v.lecture_id AND o.node = v.node
  QUALIFY s = max(s) OVER (PARTITION BY lecture_id, node) AND count(*) OVER (PARTITION BY lecture_id, node, s) = 1 AND s >= 1.5)"""
        )
    return ", ".join(parts) + f" SELECT lecture_id, node, topic, round FROM k{rounds}"


def _time_rounds(rounds: int = 12) -> str:
    """Rounds in which nodes without a time take the earliest of what they depend on."""
    parts = [f"WITH {_G}, {_T}, t0 AS MATERIALIZED (SELECT n.lecture_id, n.id AS node, t FROM n LEFT JOIN t ON t.lecture_id = n.lecture_id AND t.id = n.id)"]
    for i in range(1, rounds + 1):
        parts.append(f"t{i} AS MATERIALIZED (SELECT a.lecture_id, a.node, coalesce(a.t, o.t) AS t FROM t{i - 1} a LEFT JOIN (SELECT d.lecture_id, d.src, min(b.t) AS t FROM d JOIN t{i - 1} b ON b.lecture_id = d.lecture_id AND b.node = d.dst GROUP BY 1, 2) o ON o.lecture_id = a.lecture_id AND o.src = a.node)")
    return ", ".join(parts) + f" SELECT lecture_id, node, t FROM t{rounds}"


QUERIES = {f.__name__: f for f in (dependency_pairs, unresolved_closure, proof_support, proof_components, topic_votes, consensus_closure, effective_times, section_assignment, section_order)}
SQL = {
    "section_order": _time_rounds().rsplit(" SELECT", 1)[0].replace("WITH ", "WITH RECURSIVE ", 1)
    + """, x AS MATERIALIZED (SELECT lecture_id, node, t, CAST(floor(t / 360000) AS BIGINT) AS section FROM t12 WHERE t IS NOT NULL),
y AS MATERIALIZED (SELECT x.lecture_id, x.section, x.node, x.t, coalesce(list(q.node) FILTER (q.node IS NOT NULL), []) AS needs FROM x LEFT JOIN d ON d.lecture_id = x.lecture_id AND d.src = x.node AND d.dst <> x.node LEFT JOIN x q ON q.lecture_id = d.lecture_id AND q.node = d.dst AND q.section = x.section GROUP BY 1, 2, 3, 4),
z AS (SELECT lecture_id, section, CAST([] AS VARCHAR[]) AS done FROM (SELECT DISTINCT lecture_id, section FROM y) UNION ALL
  SELECT z.lecture_id, z.section, list_append(done, first(y.node ORDER BY y.t, y.node)) FROM z JOIN y ON y.lecture_id = z.lecture_id AND y.section = z.section WHERE NOT list_contains(done, y.node) AND list_has_all(done, needs) GROUP BY z.lecture_id, z.section, done),
f AS (SELECT lecture_id, section, arg_max(done, len(done)) AS done FROM z GROUP BY 1, 2)
SELECT y.lecture_id, y.section, y.node, CAST(CASE WHEN list_contains(done, y.node) THEN list_position(done, y.node) - 1 ELSE len(done) + row_number() OVER (PARTITION BY y.lecture_id, y.section, list_contains(done, y.node) ORDER BY y.t, y.node) - 1 END AS INT) AS place FROM y JOIN f ON f.lecture_id = y.lecture_id AND f.section = y.section""",
    "topic_votes": _topic_rounds(),
    "effective_times": _time_rounds(),
    "dependency_pairs": f"WITH {_G} SELECT lecture_id, src, dst FROM d",
    "unresolved_closure": f"WITH RECURSIVE {_G}, r AS (SELECT lecture_id, id AS node FROM n WHERE kind = 'provisional_unresolved' UNION SELECT d.lecture_id, d.src FROM r JOIN d ON d.lecture_id = r.lecture_id AND d.dst = r.node JOIN n ON n.lecture_id = d.lecture_id AND n.id = d.src WHERE n.status = 'active' AND n.kind <> 'provisional_unresolved') SELECT * FROM r",
    "proof_support": f"WITH RECURSIVE {_G}, s AS (SELECT lecture_id, src AS a, dst AS b FROM e WHERE relation = 'supported_by' UNION SELECT lecture_id, dst, src FROM e WHERE relation IN ('supports', 'leads_to')), r AS (SELECT lecture_id, id AS node FROM n WHERE kind = 'claim' AND status = 'suppressed' UNION SELECT s.lecture_id, b FROM r JOIN s ON s.lecture_id = r.lecture_id AND s.a = r.node WHERE b IS NOT NULL) SELECT * FROM r",
    "proof_components": f"WITH RECURSIVE {_G}, k AS (SELECT lecture_id, id FROM n WHERE lower(kind) IN ('proof', 'claim', 'provisional_proof_step', 'provisional_claim')), u AS (SELECT lecture_id, src AS a, dst AS b FROM e WHERE lower(relation) IN ('leads_to', 'supports', 'uses') UNION SELECT lecture_id, dst, src FROM e WHERE lower(relation) IN ('leads_to', 'supports', 'uses')), v AS (SELECT u.* FROM u SEMI JOIN k x ON x.lecture_id = u.lecture_id AND x.id = u.a SEMI JOIN k y ON y.lecture_id = u.lecture_id AND y.id = u.b), r AS (SELECT lecture_id, id AS node, id AS other FROM k UNION SELECT r.lecture_id, node, v.b FROM r JOIN v ON v.lecture_id = r.lecture_id AND v.a = r.other) SELECT lecture_id, node, min(other) AS component FROM r GROUP BY 1, 2",
    "consensus_closure": f"WITH RECURSIVE {_S2}, k AS (SELECT lecture_id, id FROM s GROUP BY lecture_id, id, kind, body HAVING count(DISTINCT state_id) = 2), d AS (SELECT DISTINCT lecture_id, id AS src, trim(unnest(derived_from)) AS dst FROM graph_nodes), q AS (SELECT d.* FROM d SEMI JOIN k ON k.lecture_id = d.lecture_id AND k.id = d.src WHERE dst <> ''), r AS (SELECT DISTINCT lecture_id, dst AS node FROM q ANTI JOIN k ON k.lecture_id = q.lecture_id AND k.id = q.dst UNION SELECT q.lecture_id, q.src FROM r JOIN q ON q.lecture_id = r.lecture_id AND q.dst = r.node) SELECT lecture_id, id AS node FROM k ANTI JOIN r ON r.lecture_id = k.lecture_id AND r.node = k.id",
    "section_assignment": f"WITH {_G}, {_T}, x AS (SELECT n.lecture_id, n.id, kind, t FROM n JOIN t ON t.lecture_id = n.lecture_id AND t.id = n.id), p AS (SELECT lecture_id, t, max(id) AS topic FROM x WHERE kind = 'topic' AND t IS NOT NULL GROUP BY 1, 2) SELECT x.lecture_id, x.id, coalesce(p.topic, 'prelude') AS section FROM x ASOF LEFT JOIN p ON x.lecture_id = p.lecture_id AND x.t >= p.t WHERE x.kind <> 'topic'",
}
