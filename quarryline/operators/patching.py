"""Changes to a property graph: absorbed nodes, event-sourced status, guarded replacements, merges. See ``patches`` for patches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scan import null_safe_join

class PatchError(ValueError):
    """A patch that would break the graph; the state stays as it was."""


#: Kinds that hold evidence only to give it a place.
PLACES = ("topic", "section", "subsection")


def suppress_absorbed(nodes: DataFrame, keys: list[str], disposed: DataFrame | None = None) -> DataFrame:
    """The nodes, provisional ones suppressed if all their evidence is held by active nodes of final kind, no mere places, or disposed of."""
    final = "status = 'active' AND NOT startswith(coalesce(kind, ''), 'provisional_')"
    firm = nodes.where(final).where(~F.coalesce(F.lower(F.trim("kind")).isin(*PLACES), F.lit(False))).select(*keys, F.explode("evidence_ids").alias("_e"))
    if disposed is not None:
        firm = firm.unionByName(disposed.select(*keys, F.col("evidence_id").alias("_e")))
    firm = firm.where("_e IS NOT NULL").distinct().withColumn("_held", F.lit(True))
    soft = nodes.where("startswith(kind, 'provisional_') AND status = 'active'").select(*keys, "id", F.explode("evidence_ids").alias("_e"))
    gone = null_safe_join(soft, firm, [*keys, "_e"], "left").groupBy(*keys, "id").agg(F.bool_and(F.coalesce("_held", F.lit(False))).alias("_gone")).where("_gone")
    joined = null_safe_join(nodes, gone, [*keys, "id"], "left")
    return joined.withColumn("status", F.when(F.col("_gone"), "suppressed").otherwise(F.col("status"))).select(*nodes.columns)


def event_status(claims: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, id, status, by_event``: active claims, superseded by a correction or retracted by a retraction that names them; the last event counts.

    ``claims`` has ``id``; ``events`` has ``target, kind, at, event_id``. Events that name nothing change nothing.
    """
    last = events.where("target IS NOT NULL").groupBy(*keys, F.col("target").alias("id")).agg(F.max_by(F.struct("kind", "event_id"), F.struct("at", "event_id")).alias("_last"))
    status = F.when(F.col("_last.kind") == "correction", "superseded").when(F.col("_last.kind") == "retraction", "retracted").otherwise("active")
    return claims.select(*keys, "id").join(last, [*keys, "id"], "left").select(*keys, "id", status.alias("status"), F.col("_last.event_id").alias("by_event"))


def guarded(patches: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Adds ``applied`` and ``reason``: the first rule that does not hold (or is unknown), else ``ok``."""
    reason = F.coalesce(*[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules], F.lit("ok"))
    return patches.withColumn("reason", reason).withColumn("applied", F.col("reason") == "ok")


def merge_into(nodes: DataFrame, edges: DataFrame, mapping: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges with each ``id`` of the mapping merged into its ``into``: evidence joined, ends rewritten, loops and repeats dropped."""
    to = mapping.select(*keys, "id", "into")
    moved = nodes.join(to, [*keys, "id"], "left").withColumn("id", F.coalesce("into", "id"))
    made = moved.select(*keys, "id", F.explode_outer("evidence_ids").alias("one")).groupBy(*keys, "id").agg(F.array_sort(F.collect_set("one")).alias("evidence_ids"))
    for end in ("src", "dst"):
        edges = edges.join(to.select(*keys, F.col("id").alias(end), F.col("into").alias(f"_{end}")), [*keys, end], "left").withColumn(end, F.coalesce(f"_{end}", end)).drop(f"_{end}")
    return made, edges.where("src <> dst").select(*keys, "src", "dst", "relation").distinct()
