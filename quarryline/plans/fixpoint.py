"""Iterated plans: reachability, components and pointer jumping, each round written out and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import release, staged


class NotConverged(RuntimeError):
    """The rounds allowed did not suffice."""


def reach(seeds: DataFrame, edges: DataFrame, keys: list[str], max_rounds: int = 100) -> DataFrame:
    """``keys, node``: nodes reached from the seeds along ``src -> dst`` within equal keys, the seeds included.

    Semi-naive: each round extends only the nodes found in the round before and drops those seen already, so cycles
    end. Null nodes are ignored.
    """
    cols = [*keys, "node"]
    seen = staged(seeds.select(*cols).where("node IS NOT NULL").distinct(), "reach")
    frontier = seen
    steps = edges.select(*keys, F.col("src").alias("node"), "dst").where("node IS NOT NULL AND dst IS NOT NULL")
    for _ in range(max_rounds):
        found = frontier.join(steps, cols).select(*keys, F.col("dst").alias("node")).distinct().join(seen, cols, "left_anti")
        frontier = staged(found, "reach")
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)
    raise NotConverged(f"reach: {max_rounds} rounds")


def components(nodes: DataFrame, edges: DataFrame, keys: list[str], max_rounds: int = 60) -> DataFrame:
    """``keys, node, component``: the smallest node of the connected component, edges taken both ways.

    Each round takes the smallest label among the neighbours and then the label of that label, which halves
    distances; hub nodes only ever send one label per edge, pre-aggregated before the shuffle.
    """
    cols = [*keys, "node"]
    both = edges.select(*keys, F.col("src").alias("a"), F.col("dst").alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    both = staged(both.unionByName(both.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    held = labels = staged(nodes.select(*cols).where("node IS NOT NULL").distinct().withColumn("component", F.col("node")), "labels")
    for _ in range(max_rounds):
        sent = labels.withColumnRenamed("node", "a").join(both, [*keys, "a"]).groupBy(*keys, F.col("b").alias("node")).agg(F.min("component").alias("offer"))
        lower = labels.join(sent, cols, "left").select(*cols, F.col("component").alias("old"), F.least("component", F.coalesce("offer", "component")).alias("component"))
        jump = labels.select(*keys, F.col("node").alias("component"), F.col("component").alias("further"))
        after = lower.join(jump, [*keys, "component"], "left").select(*cols, "old", F.least("component", F.coalesce("further", "component")).alias("component"))
        after = staged(after, "labels")
        release(held)
        held, labels = after, after.drop("old")
        if after.where("component <> old").isEmpty():
            return labels
    raise NotConverged(f"components: {max_rounds} rounds")


def resolve_aliases(aliases: DataFrame, keys: list[str], max_rounds: int = 40) -> DataFrame:
    """``keys, alias, canonical``: the end of each chain ``alias -> target``, by pointer jumping.

    A chain that runs into a cycle ends at the smallest member of the cycle. One target per alias: the smallest.
    """
    links = aliases.where("alias IS NOT NULL AND target IS NOT NULL AND alias <> target").groupBy(*keys, "alias").agg(F.min("target").alias("target"))
    links = staged(links, "aliases")
    hops, held = links.withColumn("low", F.least("alias", "target")), None
    for _ in range(max_rounds):
        further = hops.select(*keys, F.col("alias").alias("target"), F.col("target").alias("next"), F.col("low").alias("next_low"))
        moved = hops.join(further, [*keys, "target"], "left").select(*keys, "alias", F.coalesce("next", "target").alias("next"), F.least("low", "next_low").alias("low"), F.col("target").alias("was"))
        moved = staged(moved.select(*keys, "alias", F.col("next").alias("target"), "low", "was"), "aliases")
        if held is not None:
            release(held)
        ended = moved.where("target <> was").isEmpty()
        hops, held = moved.drop("was"), moved
        if ended:  # all targets stand still, some of them perhaps on a circle that a power of two goes round
            break
        if hops.join(links.select(*keys, F.col("alias").alias("target")), [*keys, "target"], "left_semi").isEmpty():
            return hops.select(*keys, "alias", F.col("target").alias("canonical"))
        if _ == max_rounds // 2:  # 2^20 links: what still moves runs in a cycle
            break
    loops = hops.join(links.select(*keys, F.col("alias").alias("target")), [*keys, "target"], "left_semi")
    ends = hops.join(links.select(*keys, F.col("alias").alias("target")), [*keys, "target"], "left_anti")
    # After so many hops a target inside a cycle has gone all round it, so its lowest is the cycle's.
    round_ = hops.select(*keys, F.col("alias").alias("target"), F.col("low").alias("lowest"))
    looped = loops.join(round_, [*keys, "target"]).select(*keys, "alias", F.col("lowest").alias("canonical"))
    return ends.select(*keys, "alias", F.col("target").alias("canonical")).unionByName(looped)
