"""Operators on property graphs: dependencies, propagation, support, components, membership, order."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.fixpoint import NotConverged, components, reach
from ..plans.grouped import fold_groups
from ..plans.scan import null_safe_join, united
from ..plans.staging import release, staged

#: Relations whose source depends on their target, those that say so only of sources of some kinds, and those that say the reverse.
FORWARD = ("supported_by", "follows_from", "derived_from", "based_on", "about", "refines", "specialization_of")
GUARDED, USERS = ("uses", "uses_result"), ("proof", "proof_step", "equation", "claim")
BACKWARD = ("leads_to",)
#: How strongly a relation passes a topic on; the others that pass it weigh 1.
TOPIC_WEIGHTS = {"refines": 3.0, "about": 3.0, "proved_by": 2.5, "has_proof_step": 2.5, "supports": 2.0, "supported_by": 2.0, "uses": 1.5, "leads_to": 1.5}
TOPIC_RELATIONS = ("follows_from", "derived_from", "based_on", "specializes", "specialization_of", "defined_on", "concerns", "yields", "introduces", "denotes_convergence_in", "proof_step_of", "uses_result", "belongs_to_topic", "reused_in")
#: Relations from a topic to its member, and from a member to its topic.
HOLDS, HELD_BY = ("contains", "contains_node", "has_part"), ("part_of", "in_section", "in_topic", "belongs_to_topic")


def _relation() -> Column:
    return F.lower(F.trim("relation"))


def dependency_pairs(nodes: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, src, dst``: src depends on dst, by ``derived_from`` of the nodes or by the relation of an edge; both ends exist.

    ``nodes`` has ``id, kind, derived_from``. An edge of ``GUARDED`` counts only if its source is of one of the kinds ``USERS``. Null keys are keys like others.
    """
    own = nodes.select(*keys, F.col("id").alias("src"), F.explode(F.array_distinct("derived_from")).alias("dst")).withColumn("dst", F.trim("dst"))
    along = edges.where(_relation().isin(*FORWARD)).select(*keys, "src", "dst")
    users = nodes.where(F.lower(F.trim("kind")).isin(*USERS)).select(*keys, F.col("id").alias("src"))
    using = null_safe_join(edges.where(_relation().isin(*GUARDED)).select(*keys, "src", "dst"), users, [*keys, "src"], "left_semi")
    against = edges.where(_relation().isin(*BACKWARD)).select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))
    ids = nodes.select(*keys, "id")
    pairs = united([own, along, using, against]).where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    for end in ("src", "dst"):
        pairs = null_safe_join(pairs, ids.withColumnRenamed("id", end), [*keys, end], "left_semi")
    return pairs.select(*keys, "src", "dst")


def explicit_members(nodes: DataFrame, edges: DataFrame, topics: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, node, topic``: what edges say of topics (``topic``) and their members among ``nodes`` (``id``), in either direction."""
    down = edges.where(_relation().isin(*HOLDS)).select(*keys, F.col("src").alias("topic"), F.col("dst").alias("node"))
    up = edges.where(_relation().isin(*HELD_BY)).select(*keys, F.col("dst").alias("topic"), F.col("src").alias("node"))
    said = null_safe_join(down.unionByName(up).distinct(), topics.select(*keys, "topic"), [*keys, "topic"], "left_semi")
    return null_safe_join(said, nodes.select(*keys, F.col("id").alias("node")), [*keys, "node"], "left_semi").select(*keys, "node", "topic")


def propagate(bad: DataFrame, open_: DataFrame, depends: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, node``: the nodes of ``open_`` that depend, through open nodes only, on one of ``bad``, and the bad ones."""
    back = depends.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))
    back = back.join(open_.select(*keys, F.col("node").alias("dst")), [*keys, "dst"], "left_semi")
    return reach(bad, back.select(*keys, "src", "dst"), keys)


def support_of(seeds: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, node``: what supports the seeds, directly or through what supports or leads to it."""
    relation = F.lower(F.trim("relation"))
    down = edges.where(relation == "supported_by").select(*keys, "src", "dst")
    up = edges.where(relation.isin("supports", "leads_to")).select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"))
    return reach(seeds, down.unionByName(up), keys)


def chain_components(nodes: DataFrame, edges: DataFrame, keys: list[str], relations: tuple[str, ...], kinds: tuple[str, ...]) -> DataFrame:
    """``keys, node, component`` over edges of the relations between nodes of the kinds."""
    chosen = nodes.where(F.lower("kind").isin(*kinds)).select(*keys, F.col("id").alias("node"))
    lines = edges.where(F.lower("relation").isin(*relations))
    for end in ("src", "dst"):
        lines = lines.join(chosen.withColumnRenamed("node", end), [*keys, end], "left_semi")
    return components(chosen, lines.select(*keys, "src", "dst"), keys)


def spread_topics(members: DataFrame, nodes: DataFrame, edges: DataFrame, keys: list[str], topics: DataFrame | None = None, rounds: int = 8, least: float = 1.5) -> DataFrame:
    """``keys, node, topic, round``: the given memberships (round 0), then at most ``rounds`` rounds of votes.

    In a round every node without a topic, itself no topic, takes the one its neighbours give the most weight, if that is at
    least ``least`` and there is no tie. Edges count that run between ``nodes`` by a relation that passes topics, each as often as it is
    given. Rounds are synchronous: votes count from the next round on, so the result does not depend on the order of nodes.
    """
    weight = F.coalesce(*[F.when(_relation() == r, F.lit(w)) for r, w in TOPIC_WEIGHTS.items()], F.when(_relation().isin(*TOPIC_RELATIONS), F.lit(1.0)))
    lines = edges.withColumn("w", weight).where("w IS NOT NULL").select(*keys, "src", "dst", "w")
    for end in ("src", "dst"):
        lines = lines.join(nodes.select(*keys, F.col("id").alias(end)), [*keys, end], "left_semi")
    lines = staged(lines.unionByName(lines.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"), "w")), "topics")
    ids = nodes.select(*keys, F.col("id").alias("node"))
    if topics is not None:
        ids = ids.join(topics.select(*keys, F.col("topic").alias("node")), [*keys, "node"], "left_anti")
    known = staged(members.select(*keys, "node", "topic").distinct().withColumn("round", F.lit(0)), "topics")
    for number in range(1, rounds + 1):
        votes = known.withColumnRenamed("node", "src").join(lines, [*keys, "src"]).groupBy(*keys, F.col("dst").alias("node"), "topic").agg(F.sum("w").alias("w"))
        votes = votes.join(ids, [*keys, "node"], "left_semi").join(known, [*keys, "node"], "left_anti")
        best = votes.groupBy(*keys, "node").agg(F.max("w").alias("best"), F.max_by("topic", "w").alias("topic"), F.sort_array(F.collect_list("w"), False).alias("all"))
        won = best.where((F.col("best") >= least) & (F.coalesce(F.try_element_at("all", F.lit(2)), F.lit(-1.0)) < F.col("best")))
        won = staged(won.select(*keys, "node", "topic", F.lit(number).alias("round")), "topics")
        if won.isEmpty():
            break
        known = known.unionByName(won)
    return known


def earliest_times(own: DataFrame, depends: DataFrame, keys: list[str], max_rounds: int = 30) -> DataFrame:
    """``keys, node, t``: a node's own time, else the earliest of what it depends on, through as many steps as it takes.

    ``own`` has ``node, t`` with null for nodes without evidence. Nodes that reach no time keep null. Cycles end, as a
    time is only ever given once.
    """
    timed = staged(own.select(*keys, "node", "t"), "times")
    for _ in range(max_rounds):
        given = timed.where("t IS NOT NULL").select(*keys, F.col("node").alias("dst"), F.col("t").alias("dt"))
        offers = depends.join(timed.where("t IS NULL").select(*keys, F.col("node").alias("src")), [*keys, "src"], "left_semi").join(given, [*keys, "dst"]).groupBy(*keys, F.col("src").alias("node")).agg(F.min("dt").alias("offer"))
        offers = staged(offers, "times")
        if offers.isEmpty():
            return timed
        before = timed
        timed = staged(timed.join(offers, [*keys, "node"], "left").select(*keys, "node", F.coalesce("t", "offer").alias("t")), "times")
        release(before)
        release(offers)
    raise NotConverged(f"earliest_times: {max_rounds} rounds")


def kahn(nodes: list[tuple], depends: dict) -> list:
    """Ids in an order that puts dependencies first, by (time, id) among those that are free; cycles come last, by (time, id).

    ``nodes`` are (time or None, id); ``depends`` maps an id to the ids it needs.
    """
    key = {i: (t is None, t if t is not None else 0, i) for t, i in nodes}
    needs = {i: {d for d in depends.get(i, ()) if d in key and d != i} for i in key}
    needed_by: dict = {}
    for i, ds in needs.items():
        for d in ds:
            needed_by.setdefault(d, []).append(i)
    left = {i: len(ds) for i, ds in needs.items()}
    free = [key[i] for i, n in left.items() if not n]
    heapq.heapify(free)
    out = []
    while free:
        i = heapq.heappop(free)[2]
        out.append(i)
        for j in needed_by.get(i, ()):
            left[j] -= 1
            if not left[j]:
                heapq.heappush(free, key[j])
    done = set(out)
    return out + [k[2] for k in sorted(k for i, k in key.items() if i not in done)]


def ordered_sections(nodes: DataFrame, depends: DataFrame, group: list[str]) -> DataFrame:
    """``group, node, place``: dependency order within each section. ``nodes`` has ``group, node, t``; a section's rows are bounded by its window."""
    inside = depends.join(nodes.select(*group, F.col("node").alias("dst")), [*group, "dst"], "left_semi")
    needs = inside.groupBy(*group, F.col("src").alias("node")).agg(F.sort_array(F.collect_set("dst")).alias("needs"))
    rows = nodes.join(needs, [*group, "node"], "left")

    def fold(part: list[dict]) -> list[dict]:
        head = {g: part[0][g] for g in group}
        return [{**head, "node": i, "place": n} for n, i in enumerate(kahn([(r["t"], r["node"]) for r in part], {r["node"]: r["needs"] or [] for r in part}))]

    typed = ", ".join(f"`{g}` {nodes.schema[g].dataType.simpleString()}" for g in group)
    return fold_groups(rows, group, ["node"], fold, f"{typed}, node string, place int")
