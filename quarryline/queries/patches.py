"""Patches of the lecture graphs, one query per kind of operation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.orphans import clean_key
from ..operators.patches import Graphs, apply_patches, expand, frontier
from ..plans.scan import united
from ..plans.staging import staged
from . import base

_L = ["lecture_id"]


def _graphs(spark: SparkSession, directory: str) -> Graphs:
    """The lecture graphs with tidy references; what a node cites counts as evidence that exists. Violations: unresolved nodes."""
    tidy = lambda c: F.coalesce(F.filter(F.transform(c, clean_key), lambda x: x.isNotNull()), F.array().cast("array<string>")).alias(c)
    texts = [F.col(c) for c in ("kind", "title", "semantic_text", "latex")]
    lists = [tidy(c) for c in ("evidence_ids", "derived_from", "aliases")]
    nodes = staged(base.nodes(spark, directory).select("lecture_id", "id", *texts, *lists, "status", F.lit(None).cast("string").alias("alternative_group")), "graph")
    edges = base.edges(spark, directory).where("src <> '' AND dst <> ''").select("lecture_id", F.col("src").alias("source"), F.col("dst").alias("target"), "relation", F.array().cast("array<string>").alias("evidence_ids")).distinct()
    evidence = nodes.select("lecture_id", F.explode("evidence_ids").alias("id")).unionByName(base.observations(spark, directory).select("lecture_id", "id")).distinct()
    violations = nodes.where("kind = 'provisional_unresolved'").select("lecture_id", F.concat(F.lit("v:"), "id").alias("id"), F.lit("evidence").alias("category"), F.lit(1).alias("severity"), F.lit("unresolved").alias("message"))
    return Graphs(_L, nodes, edges, evidence, spark.createDataFrame([], "lecture_id string, evidence_id string, disposition string"), violations)


def _steps(nodes: DataFrame, op: str, seq: int = 0, **fields: Column) -> DataFrame:
    """One operation per row of ``nodes``."""
    return nodes.select("lecture_id", F.lit(seq).alias("seq"), F.to_json(F.struct(F.lit(op).alias("op"), *[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"}).alias("operation"))


def _patched(g: Graphs, *steps: DataFrame) -> Graphs:
    return apply_patches(g, united(steps))[0]


def _of(g: Graphs, kind: str) -> DataFrame:
    return g.nodes.where(F.col("kind") == kind)


def _joined(column: str) -> Column:
    return F.array_join(F.array_sort(column), " ").alias(column)


def patched_additions(spark: SparkSession, directory: str) -> DataFrame:
    """A claim added for each topic, and a remark derived from it."""
    g = _graphs(spark, directory)
    claim = F.struct(F.concat("id", F.lit("+")).alias("id"), F.lit("claim").alias("kind"), "title")
    remark = F.struct(F.concat("id", F.lit("*")).alias("id"), F.lit("remark").alias("kind"), F.array(F.concat("id", F.lit("+"))).alias("derived_from"))
    after = _patched(g, _steps(_of(g, "topic"), "add_node", node=claim), _steps(_of(g, "topic"), "add_derived_node", 1, node=remark))
    return after.nodes.where("endswith(id, '+') OR endswith(id, '*')").select("lecture_id", "id", "kind", "title", _joined("derived_from"), "status")


def patched_kinds(spark: SparkSession, directory: str) -> DataFrame:
    """Events made remarks."""
    g = _graphs(spark, directory)
    after = _patched(g, _steps(_of(g, "event"), "retype_node", node_id=F.col("id"), kind=F.lit("remark")))
    return after.nodes.where("kind IN ('event', 'remark')").select("lecture_id", "id", "kind")


def patched_fields(spark: SparkSession, directory: str) -> DataFrame:
    """Proofs given a title, their formula cleared, their text left."""
    g = _graphs(spark, directory)
    after = _patched(g, _steps(_of(g, "proof"), "replace_node", node_id=F.col("id"), title=F.lit("Proof"), latex=F.lit(None).cast("string")))
    return _of(after, "proof").select("lecture_id", "id", "title", "latex", "semantic_text")


def patched_aliases(spark: SparkSession, directory: str) -> DataFrame:
    """Claims given an alias."""
    g = _graphs(spark, directory)
    return _of(_patched(g, _steps(_of(g, "claim"), "add_alias", node_id=F.col("id"), alias=F.concat(F.lit("~"), "id"))), "claim").select("lecture_id", "id", _joined("aliases"))


def patched_relations(spark: SparkSession, directory: str) -> DataFrame:
    """An edge from each topic to the first claim of its lecture."""
    g = _graphs(spark, directory)
    first = _of(g, "claim").groupBy("lecture_id").agg(F.min("id").alias("claim"))
    after = _patched(g, _steps(_of(g, "topic").join(first, "lecture_id"), "add_relation", source=F.col("id"), target=F.col("claim"), relation=F.lit("states")))
    return after.edges.where("relation = 'states'").select("lecture_id", "source", "target")


def patched_evidence(spark: SparkSession, directory: str) -> DataFrame:
    """The first observation of the lecture attached to each proof."""
    g = _graphs(spark, directory)
    first = base.observations(spark, directory).groupBy("lecture_id").agg(F.min("id").alias("o"))
    after = _patched(g, _steps(_of(g, "proof").join(first, "lecture_id"), "attach_evidence", node_id=F.col("id"), evidence_ids=F.array("o")))
    return _of(after, "proof").select("lecture_id", "id", _joined("evidence_ids"))


def patched_dispositions(spark: SparkSession, directory: str) -> DataFrame:
    """What topics cite marked as context, claims suppressed: what they cite is disposed of too, unless it is marked."""
    g = _graphs(spark, directory)
    after = _patched(g, _steps(_of(g, "topic"), "mark_evidence", 1, evidence_ids=F.col("evidence_ids"), disposition=F.lit("context")), _steps(_of(g, "claim"), "suppress_node", node_id=F.col("id"), reason=F.lit("repeated")))
    return after.dispositions.select("lecture_id", "evidence_id", "disposition")


def patched_suppressions(spark: SparkSession, directory: str) -> DataFrame:
    """Statuses after claims are suppressed, provisional nodes with nothing open included."""
    g = _graphs(spark, directory)
    return _patched(g, _steps(_of(g, "claim"), "suppress_node", node_id=F.col("id"), reason=F.lit("repeated"))).nodes.select("lecture_id", "id", "status")


def patched_alternatives(spark: SparkSession, directory: str) -> DataFrame:
    """Proofs marked as alternatives of one group."""
    g = _graphs(spark, directory)
    return _of(_patched(g, _steps(_of(g, "proof"), "mark_alternative", node_id=F.col("id"), group=F.lit("proofs"))), "proof").select("lecture_id", "id", "status", "alternative_group")


def patched_violations(spark: SparkSession, directory: str) -> DataFrame:
    """Violations of active nodes resolved, and one added for each provisional correction."""
    g = _graphs(spark, directory)
    resolve = _steps(_of(g, "provisional_unresolved").where("status = 'active'"), "resolve_violation", violation_id=F.concat(F.lit("v:"), "id"))
    add = _steps(_of(g, "provisional_correction"), "add_violation", 1, id=F.concat(F.lit("w:"), "id"), category=F.lit("math"), severity=F.lit(2), message=F.lit("corrected"))
    return _patched(g, resolve, add).violations.select("lecture_id", "id", "category", "severity", "message")


def _merges(g: Graphs, needed: bool) -> DataFrame:
    """Per lecture its provisional remarks merged into its first claim; without ``needed`` only those that no node depends on."""
    first = _of(g, "claim").groupBy("lecture_id").agg(F.min("id").alias("into"))
    remarks = _of(g, "provisional_remark")
    if not needed:
        remarks = remarks.join(g.nodes.select("lecture_id", F.explode("derived_from").alias("id")), ["lecture_id", "id"], "left_anti")
    return _steps(remarks.groupBy("lecture_id").agg(F.array_sort(F.collect_list("id")).alias("ids")).join(first, "lecture_id"), "merge_nodes", node_ids=F.col("ids"), into_id=F.col("into"))


def patched_merges(spark: SparkSession, directory: str) -> DataFrame:
    """Nodes after the merge, with their evidence."""
    g = _graphs(spark, directory)
    return _patched(g, _merges(g, False)).nodes.select("lecture_id", "id", "kind", _joined("evidence_ids"))


def patched_merge_edges(spark: SparkSession, directory: str) -> DataFrame:
    """Edges after the merge."""
    g = _graphs(spark, directory)
    return _patched(g, _merges(g, False)).edges.select("lecture_id", "source", "target", "relation")


def patched_outcomes(spark: SparkSession, directory: str) -> DataFrame:
    """Which lectures take a merge that may remove what others depend on, and how many nodes they have after it."""
    g = _graphs(spark, directory)
    after, outcome = apply_patches(g, _merges(g, True))
    left = after.nodes.groupBy("lecture_id").agg(F.count("*").alias("nodes"))
    return outcome.join(left, "lecture_id").select("lecture_id", "applied", "nodes")


def _split(g: Graphs) -> DataFrame:
    parts = F.array(F.struct(F.concat("id", F.lit(".1")).alias("id"), "kind", "evidence_ids"), F.struct(F.concat("id", F.lit(".2")).alias("id"), F.lit("remark").alias("kind"), F.array().cast("array<string>").alias("evidence_ids")))
    needed = g.nodes.select("lecture_id", F.explode("derived_from").alias("id"))
    return _steps(_of(g, "event").join(needed, ["lecture_id", "id"], "left_anti"), "split_node", node_id=F.col("id"), replacements=parts)


def patched_splits(spark: SparkSession, directory: str) -> DataFrame:
    """Events that no node depends on split in two: kinds, evidence, and edges left per node."""
    g = _graphs(spark, directory)
    after = _patched(g, _split(g))
    ends = after.edges.select("lecture_id", F.explode(F.array_distinct(F.array("source", "target"))).alias("id")).groupBy("lecture_id", "id").agg(F.count("*").alias("edges"))
    return after.nodes.join(ends, ["lecture_id", "id"], "left").select("lecture_id", "id", "kind", _joined("evidence_ids"), F.coalesce("edges", F.lit(0)).alias("edges"))


def graph_signatures(spark: SparkSession, directory: str) -> DataFrame:
    """A hash of the nodes and edges of each graph."""
    return _graphs(spark, directory).signatures()


def expanded_branches(spark: SparkSession, directory: str) -> DataFrame:
    """Claims given an alias, then two branches: remarks merged, which may be refused, or events made remarks."""
    g = _graphs(spark, directory)
    branches = _merges(g, True).withColumn("branch", F.lit("merge")).unionByName(_steps(_of(g, "event"), "retype_node", node_id=F.col("id"), kind=F.lit("remark")).withColumn("branch", F.lit("retype")))
    after, outcome = expand(g, _steps(_of(g, "claim"), "add_alias", node_id=F.col("id"), alias=F.lit("~")), branches)
    counted = after.nodes.groupBy("lecture_id", "branch").agg(F.count("*").alias("nodes"), F.count_if(F.array_contains("aliases", "~")).alias("named"))
    return outcome.join(counted, ["lecture_id", "branch"]).select("lecture_id", "branch", "applied", "nodes", "named")


def kept_branches(spark: SparkSession, directory: str) -> DataFrame:
    """The better of two branches, which resolve one violation or all."""
    g = _graphs(spark, directory)
    soft = _of(g, "provisional_unresolved")
    every = _steps(soft, "resolve_violation", violation_id=F.concat(F.lit("v:"), "id")).withColumn("branch", F.lit("all"))
    one = _steps(soft.groupBy("lecture_id").agg(F.min("id").alias("id")), "add_alias", node_id=F.col("id"), alias=F.lit("~")).withColumn("branch", F.lit("none"))
    after, _ = expand(g, _steps(soft.limit(0), "add_alias", node_id=F.col("id"), alias=F.lit("~")), every.unionByName(one))
    return frontier(after, _L, 1).select("lecture_id", "branch", "violations")


QUERIES = {f.__name__: f for f in (expanded_branches, kept_branches, patched_additions, patched_kinds, patched_fields, patched_aliases, patched_relations, patched_evidence, patched_dispositions, patched_suppressions, patched_alternatives, patched_violations, patched_merges, patched_merge_edges, patched_outcomes, patched_splits, graph_signatures)}

_TIDY = "coalesce(list_filter(list_transform({0}, lambda x: trim(x)), lambda x: x <> ''), [])"
_N = f"""n AS (SELECT lecture_id, id, min(kind) AS kind, min(title) AS title, min(semantic_text) AS semantic_text, min(latex) AS latex, min(status) AS status, {_TIDY.format('arg_min(evidence_ids, ingested_at)')} AS ev, {_TIDY.format('arg_min(derived_from, ingested_at)')} AS der, {_TIDY.format('arg_min(aliases, ingested_at)')} AS al FROM graph_nodes GROUP BY 1, 2),
e AS (SELECT DISTINCT lecture_id, trim(source) AS source, trim(target) AS target, relation FROM graph_edges WHERE trim(source) <> '' AND trim(target) <> ''),
need AS (SELECT DISTINCT lecture_id, unnest(der) AS id FROM n), c AS (SELECT lecture_id, min(id) AS into_id FROM n WHERE kind = 'claim' GROUP BY 1)"""
_LINE = "array_to_string(list_sort({0}), ' ')"
_M = """r AS (SELECT n.lecture_id, n.id, into_id FROM n JOIN c USING (lecture_id) WHERE kind = 'provisional_remark' AND NOT EXISTS (SELECT 1 FROM need WHERE need.lecture_id = n.lecture_id AND need.id = n.id))"""
SQL = {
    "patched_additions": f"WITH {_N} SELECT lecture_id, id || '+' AS id, 'claim' AS kind, title, '' AS derived_from, 'active' AS status FROM n WHERE kind = 'topic' UNION ALL SELECT lecture_id, id || '*', 'remark', NULL, id || '+', 'active' FROM n WHERE kind = 'topic'",
    "patched_kinds": f"WITH {_N} SELECT lecture_id, id, 'remark' AS kind FROM n WHERE kind IN ('event', 'remark')",
    "patched_fields": f"WITH {_N} SELECT lecture_id, id, 'Proof' AS title, CAST(NULL AS VARCHAR) AS latex, semantic_text FROM n WHERE kind = 'proof'",
    "patched_aliases": f"WITH {_N} SELECT lecture_id, id, {_LINE.format('list_distinct(list_append(al, chr(126) || id))')} AS aliases FROM n WHERE kind = 'claim'",
    "patched_relations": f"WITH {_N} SELECT n.lecture_id, id AS source, into_id AS target FROM n JOIN c USING (lecture_id) WHERE kind = 'topic'",
    "patched_evidence": f"WITH {_N}, o AS (SELECT lecture_id, min(id) AS o FROM observations GROUP BY 1) SELECT n.lecture_id, id, CASE WHEN o IS NULL THEN {_LINE.format('ev')} ELSE {_LINE.format('list_distinct(list_append(ev, o))')} END AS evidence_ids FROM n LEFT JOIN o USING (lecture_id) WHERE kind = 'proof'",
    "patched_dispositions": f"WITH {_N}, m AS (SELECT DISTINCT lecture_id, unnest(ev) AS evidence_id FROM n WHERE kind = 'topic'), s AS (SELECT DISTINCT lecture_id, unnest(ev) AS evidence_id FROM n WHERE kind = 'claim') SELECT *, 'context' AS disposition FROM m UNION ALL SELECT *, 'suppressed:repeated' FROM s ANTI JOIN m USING (lecture_id, evidence_id)",
    "patched_suppressions": f"""WITH {_N}, p AS (SELECT DISTINCT lecture_id FROM n WHERE kind = 'claim'), a AS (SELECT lecture_id, id, kind, CASE WHEN kind = 'claim' THEN 'suppressed' ELSE status END AS status, ev FROM n),
h AS (SELECT DISTINCT lecture_id, unnest(ev) AS x FROM a WHERE status = 'active' AND NOT starts_with(kind, 'provisional_') AND kind NOT IN ('topic', 'section', 'subsection') UNION SELECT lecture_id, unnest(ev) FROM a WHERE kind = 'claim'),
x AS (SELECT lecture_id, id, unnest(ev) AS x FROM a WHERE status = 'active' AND starts_with(kind, 'provisional_')), g AS (SELECT x.lecture_id, id FROM x LEFT JOIN h ON h.lecture_id = x.lecture_id AND h.x = x.x GROUP BY 1, 2 HAVING bool_and(h.x IS NOT NULL))
SELECT a.lecture_id, a.id, CASE WHEN g.id IS NOT NULL AND p.lecture_id IS NOT NULL THEN 'suppressed' ELSE status END AS status FROM a LEFT JOIN g ON g.lecture_id = a.lecture_id AND g.id = a.id LEFT JOIN p ON p.lecture_id = a.lecture_id""",
    "patched_alternatives": f"WITH {_N} SELECT lecture_id, id, 'alternative' AS status, 'proofs' AS alternative_group FROM n WHERE kind = 'proof'",
    "patched_violations": f"WITH {_N} SELECT lecture_id, 'v:' || id AS id, 'evidence' AS category, 1 AS severity, 'unresolved' AS message FROM n WHERE kind = 'provisional_unresolved' AND status <> 'active' UNION ALL SELECT lecture_id, 'w:' || id, 'math', 2, 'corrected' FROM n WHERE kind = 'provisional_correction'",
    "patched_merges": f"WITH {_N}, {_M}, u AS (SELECT n.lecture_id, coalesce(into_id, n.id) AS id, unnest(ev) AS x FROM n LEFT JOIN r ON r.lecture_id = n.lecture_id AND r.id = n.id), l AS (SELECT lecture_id, id, string_agg(DISTINCT x, ' ' ORDER BY x) AS evidence_ids FROM u GROUP BY 1, 2) SELECT n.lecture_id, n.id, kind, CASE WHEN n.id = c.into_id AND EXISTS (SELECT 1 FROM r WHERE r.lecture_id = n.lecture_id) THEN coalesce(l.evidence_ids, '') ELSE {_LINE.format('ev')} END AS evidence_ids FROM n LEFT JOIN l ON l.lecture_id = n.lecture_id AND l.id = n.id LEFT JOIN c ON c.lecture_id = n.lecture_id ANTI JOIN r ON r.lecture_id = n.lecture_id AND r.id = n.id",
    "patched_merge_edges": f"WITH {_N}, {_M}, m AS (SELECT e.lecture_id, coalesce(a.into_id, source) AS source, coalesce(b.into_id, target) AS target, relation FROM e LEFT JOIN r a ON a.lecture_id = e.lecture_id AND a.id = source LEFT JOIN r b ON b.lecture_id = e.lecture_id AND b.id = target) SELECT DISTINCT * FROM m WHERE source <> target OR NOT EXISTS (SELECT 1 FROM r WHERE r.lecture_id = m.lecture_id)",
    "expanded_branches": f"WITH {_N}, r AS (SELECT n.lecture_id, id, into_id FROM n JOIN c USING (lecture_id) WHERE kind = 'provisional_remark'), d AS (SELECT lecture_id, id AS who, unnest(der) AS needs FROM n), b AS (SELECT DISTINCT d.lecture_id FROM d JOIN r ON r.lecture_id = d.lecture_id AND r.id = d.needs WHERE d.who <> into_id AND NOT EXISTS (SELECT 1 FROM r q WHERE q.lecture_id = d.lecture_id AND q.id = d.who)), k AS (SELECT lecture_id, count(*) AS k FROM r GROUP BY 1), t AS (SELECT lecture_id, count(*) AS t FROM n GROUP BY 1) SELECT k.lecture_id, 'merge' AS branch, b.lecture_id IS NULL AS applied, CASE WHEN b.lecture_id IS NULL THEN t - k ELSE t END AS nodes, CASE WHEN b.lecture_id IS NULL THEN coalesce(q, 0) ELSE 0 END AS named FROM k JOIN t USING (lecture_id) LEFT JOIN b ON b.lecture_id = k.lecture_id LEFT JOIN (SELECT lecture_id, count(*) AS q FROM n WHERE kind = 'claim' GROUP BY 1) u ON u.lecture_id = k.lecture_id UNION ALL SELECT t.lecture_id, 'retype', true, t, (SELECT count(*) FROM n WHERE n.lecture_id = t.lecture_id AND kind = 'claim') FROM t WHERE EXISTS (SELECT 1 FROM n WHERE n.lecture_id = t.lecture_id AND kind = 'event')",
    "kept_branches": f"WITH {_N} SELECT DISTINCT lecture_id, 'all' AS branch, 0 AS violations FROM n WHERE kind = 'provisional_unresolved'",
    "patched_outcomes": f"WITH {_N}, r AS (SELECT n.lecture_id, id, into_id FROM n JOIN c USING (lecture_id) WHERE kind = 'provisional_remark'), d AS (SELECT lecture_id, id AS who, unnest(der) AS needs FROM n), b AS (SELECT DISTINCT d.lecture_id FROM d JOIN r ON r.lecture_id = d.lecture_id AND r.id = d.needs WHERE d.who <> into_id AND NOT EXISTS (SELECT 1 FROM r q WHERE q.lecture_id = d.lecture_id AND q.id = d.who)), k AS (SELECT lecture_id, count(*) AS k FROM r GROUP BY 1), t AS (SELECT lecture_id, count(*) AS t FROM n GROUP BY 1) SELECT k.lecture_id, b.lecture_id IS NULL AS applied, CASE WHEN b.lecture_id IS NULL THEN t - k ELSE t END AS nodes FROM k JOIN t USING (lecture_id) LEFT JOIN b ON b.lecture_id = k.lecture_id",
    "patched_splits": f"WITH {_N}, s AS (SELECT lecture_id, id, ev FROM n ANTI JOIN need ON need.lecture_id = n.lecture_id AND need.id = n.id WHERE kind = 'event'), f AS (SELECT * FROM e ANTI JOIN s a ON a.lecture_id = e.lecture_id AND a.id = e.source ANTI JOIN s b ON b.lecture_id = e.lecture_id AND b.id = e.target), z AS (SELECT lecture_id, id, count(*) AS k FROM (SELECT lecture_id, source AS id FROM f UNION ALL SELECT lecture_id, target FROM f WHERE source <> target) GROUP BY 1, 2) SELECT n.lecture_id, n.id, kind, {_LINE.format('ev')} AS evidence_ids, coalesce(k, 0) AS edges FROM n ANTI JOIN s ON s.lecture_id = n.lecture_id AND s.id = n.id LEFT JOIN z ON z.lecture_id = n.lecture_id AND z.id = n.id UNION ALL SELECT lecture_id, id || '.1', 'event', {_LINE.format('ev')}, 0 FROM s UNION ALL SELECT lecture_id, id || '.2', 'remark', '', 0 FROM s",
    "graph_signatures": f"""WITH {_N}, t AS (SELECT lecture_id, concat_ws(chr(31), id, coalesce(kind, chr(0)), coalesce(title, chr(0)), coalesce(semantic_text, chr(0)), coalesce(latex, chr(0)), array_to_string(ev, chr(30)), array_to_string(der, chr(30)), array_to_string(al, chr(30)), coalesce(status, chr(0)), chr(0)) AS t FROM n UNION ALL SELECT lecture_id, concat_ws(chr(31), source, target, coalesce(relation, chr(0)), '') FROM e)
SELECT lecture_id, count(*) || '.' || sum(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT)) AS signature FROM t GROUP BY 1""",
}
