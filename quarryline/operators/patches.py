"""Patches of property graphs as tables: operations in rows, applied to many graphs at once, each all or nothing.

A patch is the operations of one graph, in order of ``seq``. Only what a patch names is brought together: the nodes it
names, those that depend on them, and whether the evidence it names exists. From these one fold per patch works out rows of
changes, or why the patch is refused; joins then carry the changes out. A graph of any size is never gathered, only its
patch is, and no operation runs a job of its own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..plans.grouped import fold_groups
from ..plans.scan import null_safe_join, united
from ..plans.staging import staged
from .patching import PatchError, suppress_absorbed

LISTS = ("evidence_ids", "derived_from", "aliases")
TEXTS = ("kind", "title", "semantic_text", "latex", "status", "alternative_group")
#: Fields that a null given by name clears; a null for any other leaves it.
CLEARABLE = ("semantic_text", "latex", "alternative_group")
NODE = "id string, kind string, title string, semantic_text string, latex string, evidence_ids array<string>, derived_from array<string>, aliases array<string>, status string, alternative_group string"
#: What else an id of an operation may be called.
CALLED = {"suppress_node": ("node_id", "id"), "replace_node": ("node_id", "id"), "retype_node": ("node_id", "id"), "resolve_violation": ("violation_id", "id")}


@dataclass(frozen=True)
class Graphs:
    """The tables of any number of graphs, told apart by ``keys`` (STRING).

    ``nodes`` as ``NODE``; ``edges``: source, target, relation, evidence_ids; ``evidence``: id; ``dispositions``: evidence_id,
    disposition; ``violations``: id, category, severity INT, message.
    """

    keys: list[str]
    nodes: DataFrame
    edges: DataFrame
    evidence: DataFrame
    dispositions: DataFrame
    violations: DataFrame

    def signatures(self) -> DataFrame:
        """``keys, signature``: equal for graphs with the same nodes and edges, in whatever order."""
        text = lambda cols: F.concat_ws("\x1f", *[F.coalesce(F.concat_ws("\x1e", c) if c in LISTS else F.col(c), F.lit("\x00")) for c in cols])
        rows = self.nodes.select(*self.keys, text(f.split()[0] for f in NODE.split(", ")).alias("t")).unionByName(self.edges.select(*self.keys, text(("source", "target", "relation", "evidence_ids")).alias("t")))
        mark = F.conv(F.substring(F.md5(F.col("t").cast("binary")), 1, 8), 16, 10).cast("bigint")
        return rows.groupBy(*self.keys).agg(F.concat_ws(".", F.count("*"), F.sum(mark)).alias("signature"))


def provisional(node_id: str) -> bool:
    """Whether an id is one of a provisional observation, which an earlier merge may have taken in already."""
    return node_id.startswith(("obs::", "obs_"))


def repaired(operation: dict) -> dict:
    """The operation with ids under their own names and fields of the node lifted out of ``metadata`` or ``metadata_update``."""
    out = dict(operation)
    for name, *others in [CALLED.get(out.get("op"), ("op",))]:
        for other in others:
            if name not in out and other in out:
                out[name] = out.pop(other)
    extra = out.pop("metadata_update", None) or out.pop("metadata", None)
    if isinstance(extra, dict) and out.get("op") in ("merge_nodes", "replace_node"):
        out |= {k: v for k, v in extra.items() if k in (*LISTS, *TEXTS) and out.get(k) is None}
    return out


def _named(operation: dict) -> Iterator[tuple[str, str]]:
    """``(node or evidence, id)`` of everything an operation names."""
    inner = [operation.get("node"), *(operation.get("replacements") or [])]
    for part in (operation, *(p for p in inner if p)):
        for name in ("node_id", "into_id", "source", "target"):
            if part.get(name):
                yield "node", part[name]
        if part is not operation and part.get("id"):
            yield "node", part["id"]
        for name in ("node_ids", "derived_from"):
            yield from (("node", i) for i in part.get(name) or [])
        yield from (("evidence", i) for i in part.get("evidence_ids") or [])


def _once(values) -> list:
    return list(dict.fromkeys(values))


@dataclass
class _Patch:
    """One graph's patch at work: what is known of the nodes it names, and the changes so far."""

    nodes: dict[str, dict] = field(default_factory=dict)
    evidence: set[str] = field(default_factory=set)
    dependents: list[tuple[str, str]] = field(default_factory=list)
    went: dict[str, str | None] = field(default_factory=dict)  # a node's edges now belong to this one, or to none
    lines: list[dict] = field(default_factory=list)
    marks: dict[str, tuple[str, bool]] = field(default_factory=dict)  # disposition, and whether one that is there stays
    violations: dict[str, dict | None] = field(default_factory=dict)
    merged: bool = False

    def node(self, node_id: str) -> dict:
        if node_id not in self.nodes:
            raise PatchError(f"unknown node: {node_id}")
        return self.nodes[node_id]

    def needs(self, evidence: list[str] | None = (), nodes: list[str] | None = ()) -> None:
        if lost := [e for e in evidence or () if e not in self.evidence]:
            raise PatchError(f"unknown evidence: {', '.join(sorted(lost))}")
        if lost := [n for n in nodes or () if n not in self.nodes]:
            raise PatchError(f"unknown node: {', '.join(sorted(lost))}")

    def put(self, node: dict) -> None:
        if node["id"] in self.nodes:
            raise PatchError(f"node exists: {node['id']}")
        self.nodes[node["id"]] = {**dict.fromkeys(TEXTS), "status": "active", **{c: [] for c in LISTS}, **{k: v for k, v in node.items() if k in ("id", *TEXTS, *LISTS) and v is not None}}

    def leave(self, gone: set[str], to: str | None) -> None:
        for was in {*gone, *(k for k, v in self.went.items() if v in gone)}:
            self.went[was] = to
        moved = ({**x, **{end: to for end in ("source", "target") if x[end] in gone}} for x in self.lines)
        self.lines = [x for x in moved if x["source"] is not None and x["target"] is not None and not (to and x["source"] == x["target"])]

    # -- the operations
    def add_node(self, op: dict) -> None:
        self.needs(op["node"].get("evidence_ids"), op["node"].get("derived_from"))
        self.put(op["node"])

    add_derived_node = add_node

    def merge_nodes(self, op: dict) -> None:
        """The nodes become ``into_id``, one of them or another; evidence and aliases are joined, other fields are the target's unless given.

        Provisional nodes that are gone already are passed over if the target is there.
        """
        into, there = op["into_id"], op["into_id"] in self.nodes
        members = _once(op["node_ids"])
        lost = [i for i in members if i not in self.nodes]
        if lost and not (there and all(map(provisional, lost))):
            raise PatchError(f"unknown node: {', '.join(sorted(lost))}")
        members = [i for i in members if i in self.nodes]
        if not members:
            return
        if there:
            members = _once([*([into] if into not in members else []), *members])
        if len(members) < 2:
            raise PatchError("a merge takes two nodes or more")
        rows, gone = [self.nodes[i] for i in members], {i for i in members if i != into}
        base = self.nodes[into] if there else rows[0]
        self.needs(op.get("evidence_ids"))
        given = {k: op[k] for k in TEXTS if k in op and (op[k] is not None or k in CLEARABLE)}
        joined = {c: _once([x for r in rows for x in r[c] or []]) for c in LISTS}
        for c in ("evidence_ids", "aliases"):
            joined[c] = _once([*joined[c], *(op.get(c) or [])])
        if op.get("derived_from") is not None:
            self.needs((), op["derived_from"])
            joined["derived_from"] = _once(op["derived_from"])
        joined["derived_from"] = [d for d in joined["derived_from"] if d not in gone and d != into]
        for i in gone:
            del self.nodes[i]
        self.nodes[into] = {**base, **given, **joined, "id": into}
        self.leave(gone, into)
        self.merged = True

    def split_node(self, op: dict) -> None:
        """The node gives way to two or more that hold all its evidence; its edges go."""
        if len(op["replacements"]) < 2:
            raise PatchError("a split gives two nodes or more")
        old = self.node(op["node_id"])
        del self.nodes[op["node_id"]]
        for part in op["replacements"]:
            self.needs(part.get("evidence_ids"))
            self.put(part)
        if lost := set(old["evidence_ids"] or []) - {e for p in op["replacements"] for e in p.get("evidence_ids") or []}:
            raise PatchError(f"the split would drop evidence: {', '.join(sorted(lost))}")
        self.leave({op["node_id"]}, None)

    def retype_node(self, op: dict) -> None:
        self.node(op["node_id"])["kind"] = op["kind"]

    def replace_node(self, op: dict) -> None:
        node = self.node(op["node_id"])
        self.needs(op.get("evidence_ids"), op.get("derived_from"))
        node |= {k: op[k] for k in TEXTS if k in op and (op[k] is not None or k in CLEARABLE)}
        node |= {c: _once(op[c]) for c in LISTS if op.get(c) is not None}

    def add_alias(self, op: dict) -> None:
        node = self.node(op["node_id"])
        node["aliases"] = _once([*(node["aliases"] or []), op["alias"]])

    def add_relation(self, op: dict) -> None:
        self.needs((), [op["source"], op["target"]])
        self.lines.append({"source": op["source"], "target": op["target"], "relation": op["relation"], "evidence_ids": op.get("evidence_ids") or []})

    def attach_evidence(self, op: dict) -> None:
        node = self.node(op["node_id"])
        self.needs(op["evidence_ids"])
        node["evidence_ids"] = _once([*(node["evidence_ids"] or []), *op["evidence_ids"]])

    def mark_evidence(self, op: dict) -> None:
        self.needs(op["evidence_ids"])
        self.marks |= {e: (op["disposition"], False) for e in op["evidence_ids"]}

    def mark_alternative(self, op: dict) -> None:
        self.node(op["node_id"]).update(status="alternative", alternative_group=op["group"])

    def suppress_node(self, op: dict) -> None:
        if op["node_id"] not in self.nodes and provisional(op["node_id"]):
            return
        node = self.node(op["node_id"])
        node["status"] = "suppressed"
        for e in node["evidence_ids"] or []:
            self.marks.setdefault(e, (f"suppressed:{op.get('reason') or 'requested'}", True))

    def add_violation(self, op: dict) -> None:
        self.violations[op["id"]] = {"category": op.get("category") or "structure", "severity": int(op.get("severity") or 1), "message": op.get("message") or ""}

    def resolve_violation(self, op: dict) -> None:
        self.violations[op["violation_id"]] = None

    def check(self, before: set[str]) -> None:
        """Nothing left may depend on a node that went."""
        gone = before - set(self.nodes)
        left = {d for n in self.nodes.values() for d in n["derived_from"] or []} | {d for who, d in self.dependents if who not in before}
        if lost := gone & left:
            raise PatchError(f"unknown dependency: {', '.join(sorted(lost))}")


OPERATIONS = ("add_node", "merge_nodes", "split_node", "retype_node", "replace_node", "add_derived_node", "add_alias", "add_relation", "attach_evidence", "mark_evidence", "mark_alternative", "suppress_node", "add_violation", "resolve_violation")


def _work(rows: list[dict]) -> list[tuple[str, str, str | None]]:
    """The changes ``(what, id, body)`` of one patch from the rows of what it names and its operations in order."""
    patch, steps = _Patch(), []
    for r in rows:
        if r["what"] == "node":
            patch.nodes[r["id"]] = json.loads(r["body"])
        elif r["what"] == "evidence":
            patch.evidence.add(r["id"])
        elif r["what"] == "dependent":
            patch.dependents.append((r["id"], r["body"]))
        else:
            steps.append(r["body"])
    for node in patch.nodes.values():
        for c in LISTS:
            node[c] = list(node.get(c) or [])
        for c in TEXTS:
            node.setdefault(c, None)
    before = {i: json.dumps(n, sort_keys=True) for i, n in patch.nodes.items()}
    try:
        for step in steps:
            op = repaired(json.loads(step))
            if op.get("op") not in OPERATIONS:
                raise PatchError(f"unknown operation: {op.get('op')}")
            getattr(patch, op["op"])(op)
        patch.check(set(before))
    except PatchError as e:
        return [("refused", "", str(e))]
    except (KeyError, TypeError, ValueError) as e:
        return [("refused", "", f"malformed operation: {e}")]
    out = [("gone", i, None) for i in before if i not in patch.nodes]
    out += [("node", i, json.dumps(n)) for i, n in patch.nodes.items() if before.get(i) != json.dumps(n, sort_keys=True)]
    out += [("went", i, to) for i, to in patch.went.items()]
    out += [("edge", "", json.dumps(x)) for x in patch.lines]
    out += [("mark_default" if kept else "mark", e, d) for e, (d, kept) in patch.marks.items()]
    out += [("resolved", i, None) if v is None else ("violation", i, json.dumps(v)) for i, v in patch.violations.items()]
    return [*out, ("applied", "merged" if patch.merged else "", None)]


def _names(keys: list[str], schema: str):
    shape = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for row in batch.to_pylist():
                try:
                    pairs = list(_named(repaired(json.loads(row["operation"]))))
                except (ValueError, AttributeError, TypeError):
                    continue  # the fold refuses the patch
                found |= {(*(row[k] for k in keys), *p) for p in pairs}
            yield pa.RecordBatch.from_pylist([dict(zip(shape.names, f)) for f in found], schema=shape)

    return run


def apply_patches(graphs: Graphs, patches: DataFrame) -> tuple[Graphs, DataFrame]:
    """The graphs after their patches, and ``keys, applied, reason``, a row per patch.

    ``patches`` has the keys, ``seq`` and ``operation``, a JSON object with ``op`` (see ``OPERATIONS``) and its fields. A patch that
    names what does not exist, repeats an id, drops evidence or leaves a node that depends on one that went is refused, and its graph
    stays as it was. After a patch provisional nodes are suppressed whose evidence final nodes hold, and edges are unique.
    """
    keys = graphs.keys
    typed = ", ".join(f"`{k}` string" for k in keys)
    steps = staged(patches.select(*keys, F.col("seq").cast("int").alias("seq"), "operation"), "operations")
    named = staged(steps.mapInArrow(_names(keys, f"{typed}, role string, id string"), f"{typed}, role string, id string").distinct(), "named")
    ids = named.where("role = 'node'").select(*keys, "id")
    body = F.to_json(F.struct(*[f.split()[0] for f in NODE.split(", ")]), {"ignoreNullFields": "false"})
    part = lambda df, what, id_, body_, seq: df.select(*keys, seq.cast("int").alias("seq"), F.lit(what).alias("what"), id_.alias("id"), body_.cast("string").alias("body"))
    first, null = F.lit(-1), F.lit(None)
    needing = graphs.nodes.select(*keys, F.col("id").alias("who"), F.explode("derived_from").alias("id"))
    rows = united([
        part(steps, "operation", F.lit(""), F.col("operation"), F.col("seq")),
        part(null_safe_join(graphs.nodes, ids, [*keys, "id"], "left_semi"), "node", F.col("id"), body, first),
        part(null_safe_join(graphs.evidence, named.where("role = 'evidence'").select(*keys, "id"), [*keys, "id"], "left_semi"), "evidence", F.col("id"), null, first),
        part(null_safe_join(needing, ids, [*keys, "id"], "left_semi"), "dependent", F.col("who"), F.col("id"), first),
    ])
    changed = f"{typed}, what string, id string, body string"
    fold = lambda part_: [{**{k: part_[0][k] for k in keys}, "what": w, "id": i, "body": b} for w, i, b in _work(part_)]
    changes = staged(fold_groups(rows, keys, ["seq", "what", "id", "body"], fold, changed), "changes")
    of = lambda *what: changes.where(F.col("what").isin(*what)).select(*keys, "id", "body")
    done = of("applied").select(*keys, (F.col("id") == "merged").alias("merged"))
    outcome = done.select(*keys, F.lit(True).alias("applied"), F.lit(None).cast("string").alias("reason")).unionByName(of("refused").select(*keys, F.lit(False).alias("applied"), F.col("body").alias("reason")))

    marked = of("mark").select(*keys, F.col("id").alias("evidence_id"), F.col("body").alias("disposition"))
    default = of("mark_default").select(*keys, F.col("id").alias("evidence_id"), F.col("body").alias("disposition"))
    kept = null_safe_join(graphs.dispositions, marked.drop("disposition"), [*keys, "evidence_id"], "left_anti")
    dispositions = united([kept, marked, null_safe_join(default, graphs.dispositions.select(*keys, "evidence_id"), [*keys, "evidence_id"], "left_anti")])

    shaped = of("node").select(*keys, F.from_json("body", NODE).alias("n")).select(*keys, "n.*")
    nodes = null_safe_join(graphs.nodes.select(*keys, *shaped.columns[len(keys):]), of("node", "gone").select(*keys, "id"), [*keys, "id"], "left_anti").unionByName(shaped)
    patched = null_safe_join(nodes, done.drop("merged"), keys, "left_semi")
    settled = suppress_absorbed(patched, keys, dispositions.where("disposition <> 'frontier_ambiguous'"))
    nodes = null_safe_join(nodes, done.drop("merged"), keys, "left_anti").unionByName(settled)

    touched = null_safe_join(graphs.edges, done, keys)
    for end in ("source", "target"):
        to = of("went").select(*keys, F.col("id").alias(end), F.lit(True).alias("_left"), F.col("body").alias("_to"))
        touched = null_safe_join(touched, to, [*keys, end], "left").where("_left IS NULL OR _to IS NOT NULL").withColumn(end, F.coalesce("_to", end)).drop("_left", "_to")
    touched = touched.where("NOT merged OR source <> target").drop("merged")
    made = of("edge").select(F.from_json("body", "source string, target string, relation string, evidence_ids array<string>").alias("x"), *keys).select(*keys, "x.*")
    united_edges = touched.withColumn("_new", F.lit(False)).unionByName(made.withColumn("_new", F.lit(True)))
    united_edges = united_edges.groupBy(*keys, "source", "target", "relation").agg(F.min_by("evidence_ids", F.struct("_new", F.to_json("evidence_ids"))).alias("evidence_ids"))
    edges = null_safe_join(graphs.edges, done.drop("merged"), keys, "left_anti").unionByName(united_edges)

    new = of("violation").select(*keys, "id", F.from_json("body", "category string, severity int, message string").alias("x")).select(*keys, "id", "x.*")
    violations = null_safe_join(graphs.violations, of("violation", "resolved").select(*keys, "id"), [*keys, "id"], "left_anti").unionByName(new)
    return Graphs(keys, nodes, edges, graphs.evidence, dispositions, violations), outcome


def expand(graphs: Graphs, common: DataFrame, branches: DataFrame) -> tuple[Graphs, DataFrame]:
    """Each graph under the common operations and then under those of each of its branches: graphs told apart by ``keys, branch``, and the outcome per branch.

    ``common`` is as for ``apply_patches``, ``branches`` has a ``branch`` (STRING) besides. Branches of a graph are few: each is a copy of it. A
    branch that is refused has its graph as it was before the common operations. Graphs without branches are left out.
    """
    keys = [*graphs.keys, "branch"]
    names = staged(branches.select(*keys).distinct(), "branches")

    def spread(df: DataFrame) -> DataFrame:
        copies = null_safe_join(df.withColumn("_one", F.lit(1)), names, graphs.keys)
        return copies.select(*keys, *[c for c in df.columns if c not in graphs.keys])

    first = spread(common.select(*graphs.keys, F.col("seq").cast("int").alias("seq"), "operation"))
    after = null_safe_join(branches.select(*keys, F.col("seq").cast("int").alias("seq"), "operation"), first.groupBy(*keys).agg(F.max("seq").alias("_last")), keys, "left")
    steps = first.unionByName(after.select(*keys, (F.col("seq") + F.coalesce("_last", F.lit(-1)) + 1).alias("seq"), "operation"))
    return apply_patches(Graphs(keys, *map(spread, (graphs.nodes, graphs.edges, graphs.evidence, graphs.dispositions, graphs.violations))), steps)


def frontier(graphs: Graphs, keys: list[str], width: int) -> DataFrame:
    """``keys, branch, violations, active, rank``: the ``width`` best different graphs of each entity: little severity of violations, then many active nodes, then by signature."""
    by = [*keys, "branch"]
    weight = graphs.violations.groupBy(*by).agg(F.sum("severity").alias("violations"))
    active = graphs.nodes.groupBy(*by).agg(F.count_if(F.col("status") == "active").alias("active"))
    rows = null_safe_join(null_safe_join(graphs.signatures(), active, by, "left"), weight, by, "left").withColumn("violations", F.coalesce("violations", F.lit(0)))
    once = rows.groupBy(*keys, "signature").agg(F.min_by(F.struct("branch", "violations", "active"), "branch").alias("x")).select(*keys, "signature", "x.*")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("violations", F.desc("active"), "signature"))
    return once.withColumn("rank", place).where(F.col("rank") <= width).select(*keys, "branch", "violations", "active", "rank")
