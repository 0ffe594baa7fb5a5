import itertools
import random

import pytest

from quarryline.operators import graphs, inference, sets
from quarryline.operators.patching import event_status, guarded
from quarryline.plans.fixpoint import components, reach, resolve_aliases
from quarryline.queries.graphs import topic_votes
from pyspark.sql import functions as F


def random_graph(seed, n=40, m=45):
    rng = random.Random(seed)
    return [("g", f"n{i}") for i in range(n)], [("g", f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(m)]


def test_reach_and_components(spark):
    nodes, edges = random_graph(1)
    n, e = spark.createDataFrame(nodes, "k string, node string"), spark.createDataFrame([*edges, ("g", None, "n1")], "k string, src string, dst string")
    seen, todo = {"n0"}, ["n0"]
    while todo:
        here = todo.pop()
        for _, a, b in edges:
            if a == here and b not in seen:
                seen.add(b)
                todo.append(b)
    assert {r["node"] for r in reach(n.where("node = 'n0'"), e, ["k"]).collect()} == seen
    label = {v: v for _, v in nodes}
    for _ in nodes:
        for _, a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {r["node"]: r["component"] for r in components(n, e, ["k"]).collect()} == label


def test_aliases_with_chains_and_cycles(spark):
    links = [("k", "a", "b"), ("k", "b", "c"), ("k", "c", "d"), ("k", "x", "y"), ("k", "y", "z"), ("k", "z", "x"), ("k", "t", "y"), ("k", "s", "s"), ("k", "0", "x"), ("k", None, "q")]
    got = {r["alias"]: r["canonical"] for r in resolve_aliases(spark.createDataFrame(links, "k string, alias string, target string"), ["k"]).collect()}
    assert got == {"a": "d", "b": "d", "c": "d", "x": "x", "y": "x", "z": "x", "t": "x", "0": "x"}


def test_aliases_in_circles_of_two_and_four(spark):
    links = [("k", "b", "a"), ("k", "a", "b"), ("k", "t", "b"), *[("j", f"n{i}", f"n{(i + 1) % 4}") for i in range(4)], ("j", "s", "n2"), ("i", "p", "q")]
    got = {(r["k"], r["alias"]): r["canonical"] for r in resolve_aliases(spark.createDataFrame(links, "k string, alias string, target string"), ["k"]).collect()}
    assert got == {("k", "a"): "a", ("k", "b"): "a", ("k", "t"): "a", **{("j", f"n{i}"): "n0" for i in range(4)}, ("j", "s"): "n0", ("i", "p"): "q"}


def test_kahn():
    assert graphs.kahn([(2, "a"), (1, "b"), (None, "c"), (0, "d")], {"d": ["c"], "b": ["a"], "c": ["zz"]}) == ["a", "b", "c", "d"]
    assert graphs.kahn([(1, "a"), (0, "b"), (5, "c")], {"a": ["b"], "b": ["a"]}) == ["c", "b", "a"]


def test_topics_times_and_order(spark):
    nodes = spark.createDataFrame([("g", x) for x in "tuabcd"], "k string, id string")
    edges = spark.createDataFrame([("g", "a", "b", "refines"), ("g", "b", "c", "uses"), ("g", "c", "d", "leads_to"), ("g", "d", "a", "odd")], "k string, src string, dst string, relation string")
    members = spark.createDataFrame([("g", "a", "t"), ("g", "d", "u")], "k string, node string, topic string")
    got = {(r["node"], r["topic"]): r["round"] for r in graphs.spread_topics(members, nodes, edges, ["k"]).collect()}
    assert got == {("a", "t"): 0, ("d", "u"): 0, ("b", "t"): 1, ("c", "u"): 1}
    own = spark.createDataFrame([("g", "a", 5), ("g", "b", None), ("g", "c", None), ("g", "d", None)], "k string, node string, t bigint")
    needs = spark.createDataFrame([("g", "b", "a"), ("g", "c", "b"), ("g", "d", "d")], "k string, src string, dst string")
    assert {r["node"]: r["t"] for r in graphs.earliest_times(own, needs, ["k"]).collect()} == {"a": 5, "b": 5, "c": 5, "d": None}
    order = graphs.ordered_sections(own, needs, ["k"]).orderBy("place").collect()
    assert [r["node"] for r in order] == ["a", "b", "c", "d"]


def test_topic_votes_run_all_rounds(spark, tmp_path):
    columns = "lecture_id string, id string, kind string, title string, semantic_text string, latex string, evidence_ids array<string>, derived_from array<string>, aliases array<string>, status string, ingested_at timestamp"
    row = lambda i, kind: ("l", i, kind, None, None, None, [], [], [], "active", None)
    spark.createDataFrame([row("t", "topic"), *[row(f"n{i}", "claim") for i in range(10)]], columns).write.parquet(f"{tmp_path}/graph_nodes.parquet")
    edges = [("e", "l", "t", "n0", "contains"), *[(f"e{i}", "l", f"n{i}", f"n{i + 1}", "refines") for i in range(9)]]
    spark.createDataFrame(edges, "edge_id string, lecture_id string, source string, target string, relation string").write.parquet(f"{tmp_path}/graph_edges.parquet")
    got = {r["node"]: (r["topic"], r["round"]) for r in topic_votes(spark, str(tmp_path)).collect()}
    assert got == {f"n{i}": ("t", i) for i in range(9)}  # round 8 is the last


def test_beam_is_exact_when_wide():
    rng = random.Random(2)
    unary = [[(f"{i}{c}", rng.random()) for c in "xyz"] for i in range(5)]
    links = [list({rng.randrange(i) for _ in range(2)}) if i else [] for i in range(5)]
    pair = {(a[0], b[0]): rng.uniform(-1, 1) for i in range(5) for j in links[i] for a in unary[j] for b in unary[i]}
    score = lambda p: sum(s for _, s in p) + sum(pair[p[j][0], p[i][0]] for i in range(5) for j in links[i])
    best = sorted((score(p) for p in itertools.product(*unary)), reverse=True)[:3]
    assert [round(s, 9) for s, _ in inference.beam(unary, links, pair, 1000, 3)] == [round(s, 9) for s in best]
    assert inference.beam([], [], {}, 4, 2) == []


def test_pareto(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randrange(2), rng.randrange(12), rng.randrange(12), i) for i in range(120)] + [("a", 0, None, 1, -1)]
    got = {r["i"] for r in inference.pareto(spark.createDataFrame(rows, "k string, h int, x int, y int, i int"), ["k"], ["h"], ["x", "y"]).collect()}
    best = [r for r in rows if r[2] is not None and r[1] == min(s[1] for s in rows if s[0] == r[0] and s[2] is not None)]
    assert got == {r[4] for r in best if not any(s[0] == r[0] and s[2] <= r[2] and s[3] <= r[3] and s[2:4] != r[2:4] for s in best)}


def test_reconcile(spark):
    rows = [("l", "o1", 90, 100, r"Use $x + y$", "x+y", 0.8), ("l", "o2", 95, 105, "Use $x+y$", "x + y", 0.95), ("l", "o3", 104, 110, "another thing", None, 0.5), ("l", "o4", None, 3, "Use $x+y$", None, None)]
    got = {r["id"]: (r["canonical_id"], r["s"], r["e"], r["confidence"]) for r in sets.reconcile(spark.createDataFrame(rows, "k string, id string, s bigint, e bigint, text string, latex string, confidence double"), ["k"]).collect()}
    assert got == {"o1": ("o1", 90, 105, 0.95), "o2": ("o1", 90, 105, 0.95), "o3": ("o3", 104, 110, 0.5), "o4": ("o4", None, 3, 0.0)}


def test_events_and_guards(spark):
    claims = spark.createDataFrame([("k", x) for x in "abc"], "k string, id string")
    events = spark.createDataFrame([("k", "a", "correction", 1, "e1"), ("k", "a", "retraction", 2, "e2"), ("k", "b", "correction", None, "e3"), ("k", None, "correction", 1, "e4")], "k string, target string, kind string, at bigint, event_id string")
    got = {r["id"]: (r["status"], r["by_event"]) for r in event_status(claims, events, ["k"]).collect()}
    assert got == {"a": ("retracted", "e2"), "b": ("superseded", "e3"), "c": ("active", None)}
    p = guarded(spark.createDataFrame([(1,), (5,), (None,)], "x int"), [("small", F.col("x") > 2)]).collect()
    assert [(r["applied"], r["reason"]) for r in p] == [(False, "small"), (True, "ok"), (False, "small")]
