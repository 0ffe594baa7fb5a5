"""Edits of ordered rows: collapsing neighbours, moving, dropping and merging with coverage checked, defaults for missing pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scan import running, shifted
from .patching import PatchError


def collapse_neighbours(df: DataFrame, keys: list[str], pos: str, content: Column) -> DataFrame:
    """``keys, island, first_pos, last_pos, rows``: consecutive rows with equal content (null equal to null) as one."""
    rows = df.select(*keys, F.col(pos).alias("pos"), F.sha2(F.coalesce(content, F.lit("\x00")), 256).alias("_c"))
    rows = shifted(rows, keys, "pos", ["_c"], 1, "b")
    rows = running(rows, keys, "pos", F.when(F.col("_c") == F.col("b_c"), 0).otherwise(1), "sum", "island")
    return rows.groupBy(*keys, "island").agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.count("*").alias("rows"))


def edit_plan(blocks: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, section, id, sources``: the blocks under a plan that places each in a section, drops it or merges it into another.

    ``plan`` has ``id, action`` (keep, drop, merge), ``section`` and ``into``. Every block must be named once, every
    merge must name a kept block of the entity; otherwise `PatchError`, and nothing changes.
    """
    ids = blocks.select(*keys, "id")
    named = plan.groupBy(*keys, "id").agg(F.count("*").alias("n"))
    kept = plan.where("action = 'keep'")
    problems = {
        "block not in the plan": ids.join(named, [*keys, "id"], "left_anti"),
        "plan names an unknown block": named.join(ids, [*keys, "id"], "left_anti"),
        "block named twice": named.where("n > 1"),
        "merge into a block that is not kept": plan.where("action = 'merge'").select(*keys, F.col("into").alias("id")).join(kept.select(*keys, "id"), [*keys, "id"], "left_anti"),
    }
    for what, rows in problems.items():
        if not rows.isEmpty():
            raise PatchError(what)
    merged = plan.where("action = 'merge'").select(*keys, F.col("into").alias("id"), F.col("id").alias("source"))
    sources = merged.unionByName(kept.select(*keys, "id", F.col("id").alias("source"))).groupBy(*keys, "id").agg(F.array_sort(F.collect_list("source")).alias("sources"))
    return kept.select(*keys, "section", "id").join(sources, [*keys, "id"]).select(*keys, "section", "id", "sources")


def complete_pairs(wanted: DataFrame, scored: DataFrame, keys: list[str]) -> DataFrame:
    """Each wanted pair with its first score, or an explicit 0 marked ``uncertain``; scores of pairs not wanted are dropped.

    ``scored`` has ``pos, score``; ``keys`` name a pair.
    """
    first = scored.groupBy(*keys).agg(F.min_by("score", "pos").alias("score"))
    joined = wanted.select(*keys).distinct().join(first, keys, "left")
    return joined.select(*keys, F.coalesce("score", F.lit(0.0)).alias("score"), F.when(F.col("score").isNull(), "uncertain").otherwise("scored").alias("kind"))


def prune(states: DataFrame, signature: str, hard: list[str], soft: list[str], width: int) -> DataFrame:
    """The ``width`` best distinct states among those with the least ``hard`` tuple, by ``soft`` metrics, then signature."""
    distinct = states.groupBy(signature).agg(F.min(F.struct(*hard, *soft, *[c for c in states.columns if c not in (*hard, *soft, signature)])).alias("s")).select(signature, "s.*")
    least = distinct.agg(F.min(F.struct(*hard)).alias("_hard"))  # one row
    return distinct.join(F.broadcast(least), F.struct(*hard) == F.col("_hard")).drop("_hard").orderBy(*soft, signature).limit(width)


def canonical(df: DataFrame, aliases: dict[str, list[str]], vocabulary: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Columns under their own names: each the first that is neither null nor blank of the names it goes by, then mapped to a closed vocabulary.

    Words outside a vocabulary become its entry for ``""``, null without one. Names that a frame lacks are passed over.
    """
    out = df
    for name, others in aliases.items():
        found = [F.when(F.trim(c) != "", F.col(c)) for c in (name, *others) if c in df.columns]
        out = out.withColumn(name, F.coalesce(*found) if found else F.lit(None).cast("string"))
    for name, words in (vocabulary or {}).items():
        key = F.lower(F.trim(name))
        out = out.withColumn(name, F.coalesce(*[F.when(key == w, F.lit(v)) for w, v in words.items() if w], F.lit(words.get("")).cast("string")))
    return out.drop(*[c for others in aliases.values() for c in others if c in df.columns and c not in aliases])


def halves(rows: list, fits) -> list[list]:
    """A sequence halved until every part fits; a single row that does not is an error."""
    if not rows:
        return []
    if fits(rows):
        return [rows]
    if len(rows) == 1:
        raise PatchError("one row does not fit")
    middle = len(rows) // 2
    return halves(rows[:middle], fits) + halves(rows[middle:], fits)
