import json

import pytest
from pyspark.sql import functions as F

from quarryline.operators import patches
from quarryline.operators.patches import Graphs, apply_patches

NODE = {"kind": None, "title": None, "semantic_text": None, "latex": None, "evidence_ids": [], "derived_from": [], "aliases": [], "status": "active", "alternative_group": None}


def graphs(spark, nodes, edges=(), evidence=("e1", "e2", "e3"), marks=(), violations=(), keys=("g", "h", None)):
    names = [f.split()[0] for f in patches.NODE.split(", ")]
    rows = [(k, *({**NODE, **n}[c] for c in names)) for k in keys for n in nodes]
    return Graphs(
        ["k"],
        spark.createDataFrame(rows, f"k string, {patches.NODE}"),
        spark.createDataFrame([(k, *e, []) for k in keys for e in edges], "k string, source string, target string, relation string, evidence_ids array<string>"),
        spark.createDataFrame([(k, e) for k in keys for e in evidence], "k string, id string"),
        spark.createDataFrame([(k, *m) for k in keys for m in marks], "k string, evidence_id string, disposition string"),
        spark.createDataFrame([(k, *v) for k in keys for v in violations], "k string, id string, category string, severity int, message string"),
    )


def patched(spark, before, *operations, key="g"):
    table = spark.createDataFrame([(key, i, json.dumps(o)) for i, o in enumerate(operations)], "k string, seq int, operation string")
    after, outcome = apply_patches(before, table)
    rows = outcome.collect()
    assert len(rows) == 1 and rows[0]["k"] == key
    mine = F.col("k").eqNullSafe(F.lit(key))
    nodes = {r["id"]: r for r in after.nodes.where(mine).collect()}
    edges = sorted(tuple(r)[1:4] for r in after.edges.where(mine).collect())
    assert after.nodes.where(~mine).exceptAll(before.nodes.where(~mine)).isEmpty() and after.edges.where(~mine).count() == before.edges.where(~mine).count()
    return rows[0]["reason"], nodes, edges, after


TWO = [{"id": "a", "kind": "claim", "title": "A", "evidence_ids": ["e1"], "aliases": ["x"]}, {"id": "obs::b", "kind": "provisional_claim", "evidence_ids": ["e2"], "aliases": ["y"]}]


def test_merge_into_a_target_that_exists(spark):
    reason, nodes, edges, _ = patched(spark, graphs(spark, TWO, [("obs::b", "a", "supports"), ("a", "obs::b", "uses"), ("obs::b", "obs::b", "odd")]), {"op": "merge_nodes", "node_ids": ["obs::b"], "into_id": "a"})
    assert reason is None and set(nodes) == {"a"} and edges == []
    assert (nodes["a"]["title"], nodes["a"]["evidence_ids"], nodes["a"]["aliases"]) == ("A", ["e1", "e2"], ["x", "y"])


def test_merge_of_null_key_and_edges(spark):
    three = [*TWO, {"id": "c", "kind": "claim", "evidence_ids": ["e3"]}]
    reason, nodes, edges, _ = patched(spark, graphs(spark, three, [("obs::b", "c", "supports"), ("a", "c", "supports"), ("c", "a", "uses")]), {"op": "merge_nodes", "node_ids": ["a", "obs::b"], "into_id": "m", "kind": "theorem", "latex": None}, key=None)
    assert reason is None and set(nodes) == {"m", "c"} and edges == [("c", "m", "uses"), ("m", "c", "supports")] and nodes["m"]["kind"] == "theorem" and nodes["m"]["title"] == "A"


@pytest.mark.parametrize(
    ("operation", "why"),
    [
        ({"op": "merge_nodes", "node_ids": ["a"], "into_id": "a"}, "two nodes"),
        ({"op": "merge_nodes", "node_ids": ["gone"], "into_id": "a"}, "unknown node"),
        ({"op": "merge_nodes", "node_ids": ["obs::zz"], "into_id": "new"}, "unknown node"),
        ({"op": "split_node", "node_id": "a", "replacements": [{"id": "p", "kind": "x"}, {"id": "q", "kind": "x"}]}, "drop evidence"),
        ({"op": "split_node", "node_id": "a", "replacements": [{"id": "p", "kind": "x", "evidence_ids": ["e1"]}]}, "two nodes"),
        ({"op": "retype_node", "node_id": "gone", "kind": "x"}, "unknown node"),
        ({"op": "add_node", "node": {"id": "a", "kind": "x"}}, "exists"),
        ({"op": "add_node", "node": {"id": "n", "kind": "x", "evidence_ids": ["e9"]}}, "unknown evidence"),
        ({"op": "add_derived_node", "node": {"id": "n", "kind": "x", "derived_from": ["gone"]}}, "unknown node"),
        ({"op": "attach_evidence", "node_id": "a", "evidence_ids": ["e9"]}, "unknown evidence"),
        ({"op": "suppress_node", "node_id": "gone"}, "unknown node"),
        ({"op": "add_relation", "source": "a", "target": "gone", "relation": "uses"}, "unknown node"),
        ({"op": "merge_nodes", "node_ids": ["obs::b"], "into_id": "a", "derived_from": ["gone"]}, "unknown node"),
        ({"op": "invent"}, "unknown operation"),
        ({"op": "retype_node"}, "malformed"),
    ],
)
def test_refused_patches_change_nothing(spark, operation, why):
    before = graphs(spark, TWO)
    reason, nodes, _, after = patched(spark, before, {"op": "add_alias", "node_id": "a", "alias": "z"}, operation)
    assert why in reason and nodes["a"]["aliases"] == ["x"]
    same = lambda g: sorted(map(str, g.signatures().collect()))
    assert same(before) == same(after)


def test_a_node_that_others_need_cannot_go(spark):
    needed = [*TWO, {"id": "c", "kind": "claim", "derived_from": ["obs::b"]}]
    merge = {"op": "merge_nodes", "node_ids": ["obs::b"], "into_id": "a"}
    assert "unknown dependency" in patched(spark, graphs(spark, needed), merge)[0]
    reason, nodes, _, _ = patched(spark, graphs(spark, needed), merge, {"op": "replace_node", "node_id": "c", "derived_from": ["a"]})
    assert reason is None and nodes["c"]["derived_from"] == ["a"]


def test_late_cleanups_are_passed_over(spark):
    reason, nodes, _, _ = patched(spark, graphs(spark, TWO), {"op": "merge_nodes", "node_ids": ["obs_1", "obs_2", "obs::b"], "into_id": "a"}, {"op": "merge_nodes", "node_ids": ["obs::b"], "into_id": "a"}, {"op": "suppress_node", "node_id": "obs::b"})
    assert reason is None and nodes["a"]["evidence_ids"] == ["e1", "e2"]


def test_fields_and_their_names(spark):
    reason, nodes, _, after = patched(
        spark, graphs(spark, TWO, marks=[("e1", "kept")], violations=[("v", "math", 3, "m"), ("w", "math", 3, "m")]),
        {"op": "replace_node", "id": "a", "title": None, "latex": "x", "metadata_update": {"semantic_text": "lifted", "other": 1}},
        {"op": "replace_node", "node_id": "a", "latex": None}, {"op": "mark_alternative", "node_id": "obs::b", "group": "G"},
        {"op": "suppress_node", "id": "a"}, {"op": "mark_evidence", "evidence_ids": ["e3"], "disposition": "noise"},
        {"op": "resolve_violation", "id": "v"}, {"op": "resolve_violation", "id": "never"}, {"op": "add_violation", "id": "w", "category": "evidence", "severity": 2, "message": "n"},
    )
    a = nodes["a"]
    assert reason is None and (a["title"], a["latex"], a["semantic_text"], a["status"]) == ("A", None, "lifted", "suppressed") and nodes["obs::b"]["alternative_group"] == "G"
    assert {(r["evidence_id"], r["disposition"]) for r in after.dispositions.where("k = 'g'").collect()} == {("e1", "kept"), ("e3", "noise")}
    assert [tuple(r)[1:] for r in after.violations.where("k = 'g'").collect()] == [("w", "evidence", 2, "n")]


def test_absorbed_nodes_are_suppressed(spark):
    soft = [{"id": "p", "kind": "provisional_claim", "evidence_ids": ["e1"]}, {"id": "q", "kind": "provisional_claim"}, {"id": "t", "kind": "topic", "evidence_ids": ["e1"]}]
    assert patched(spark, graphs(spark, soft), {"op": "add_alias", "node_id": "t", "alias": "z"})[1]["p"]["status"] == "active"
    _, nodes, _, _ = patched(spark, graphs(spark, soft), {"op": "add_node", "node": {"id": "f", "kind": "claim", "evidence_ids": ["e1"]}})
    assert {i: n["status"] for i, n in nodes.items()} == {"p": "suppressed", "q": "active", "t": "active", "f": "active"}


def test_nothing_to_do(spark):
    before = graphs(spark, TWO)
    empty = spark.createDataFrame([], "k string, seq int, operation string")
    after, outcome = apply_patches(before, empty)
    assert outcome.isEmpty() and after.nodes.count() == before.nodes.count()
    assert patched(spark, graphs(spark, TWO), {"op": "split_node", "node_id": "a", "replacements": [{"id": "a", "kind": "x", "evidence_ids": ["e1"]}, {"id": "q", "kind": "x"}]})[0] is None
