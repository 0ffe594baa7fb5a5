"""Notes: what a step gets to see of its records, how parts are put together, and which corrections, plans and blocks may stand.

Keys are null-safe unless said otherwise. ``keys`` name the entity; a *batch* is a bounded part of it, such as a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scan import null_safe_join, with_position
from ..plans.staging import staged

#: How sure a line of a board is by how well it can be read, and kinds of records that are no statement.
LEGIBLE = {"clear": 0.9, "partial": 0.65, "uncertain": 0.4}
NO_STATEMENT = ("correction", "retraction", "transition", "unresolved")


# ---------------------------------------------------------------- payloads
def earlier_symbols(batches: DataFrame, symbols: DataFrame, direct: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """``keys, batch, id``: per batch the last ``limit`` symbols introduced up to its start, by (time, id), that are not its own.

    ``batches`` has ``batch, start``, ``symbols`` ``id, at``, ``direct`` ``batch, id``. Symbols are numbered once per entity; a batch looks at
    as many places before its start as it may have to pass over, so no batch meets all symbols of an entity.
    """
    placed = staged(with_position(symbols.where("at IS NOT NULL").select(*keys, "id", "at"), keys, "at", ["id"]), "symbols")
    starts = batches.where("start IS NOT NULL").select(*keys, F.col("start").alias("at"), "batch")
    both = placed.select(*keys, "at", F.lit(None).cast("string").alias("batch"), "id", F.lit(0).alias("side")).unionByName(starts.select(*keys, "at", "batch", F.lit(None).cast("string").alias("id"), F.lit(1).alias("side")))
    at_start = with_position(both, keys, "at", ["side", "id", "batch"], name="place")
    at_start = with_position(at_start.where("side = 1"), keys, "place", ["batch"], name="before").select(*keys, "batch", (F.col("place") - F.col("before")).alias("known"))
    own = direct.groupBy(*keys, "batch").agg(F.count("*").alias("own"))
    reach = null_safe_join(at_start, own, [*keys, "batch"], "left").withColumn("first", F.greatest(F.lit(0), F.col("known") - F.coalesce("own", F.lit(0)) - limit))
    looked = reach.where("known > first").select(*keys, "batch", F.explode(F.sequence(F.col("first"), F.col("known") - 1)).alias("pos"))
    found = null_safe_join(null_safe_join(looked, placed.select(*keys, "pos", "id"), [*keys, "pos"]), direct.select(*keys, "batch", "id"), [*keys, "batch", "id"], "left_anti")
    last = F.row_number().over(Window.partitionBy(*keys, "batch").orderBy(F.desc("pos")))
    return found.withColumn("n", last).where(F.col("n") <= limit).select(*keys, "batch", "id")


def relevant_symbols(probes: DataFrame, symbols: DataFrame, keys: list[str], limit: int = 8, otherwise: int = 3) -> DataFrame:
    """``keys, id, symbol``: of the symbols of a record's batch the last ``limit`` that its probe text contains, or the last ``otherwise`` if it contains none.

    ``probes`` has ``keys, id, probe`` and ``symbols`` ``keys, symbol, place``; keys name the batch, which bounds both.
    """
    pairs = null_safe_join(probes, symbols, keys).withColumn("hit", (F.col("symbol") != "") & F.contains("probe", "symbol"))
    by = Window.partitionBy(*keys, "id")
    ranked = pairs.withColumn("any", F.bool_or("hit").over(by)).where("hit OR NOT any")
    ranked = ranked.withColumn("n", F.row_number().over(by.orderBy(F.desc("place"), F.desc("symbol"))))
    return ranked.where(F.col("n") <= F.when(F.col("any"), limit).otherwise(min(limit, otherwise))).select(*keys, "id", "symbol")


def first_references(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """``keys, ref, direct, origin``: each reference as the first of the sources has it; sources have ``ref, direct, origin``. Null and blank ones are left out."""
    rows = None
    for n, df in enumerate(sources):
        part = df.select(*keys, F.trim("ref").alias("ref"), "direct", "origin", F.lit(n).alias("source")).where("ref <> ''")
        rows = part if rows is None else rows.unionByName(part)
    one = rows.groupBy(*keys, "ref").agg(F.min(F.struct("source", "origin", "direct")).alias("x"))
    return one.select(*keys, "ref", "x.direct", "x.origin")


def across_boundary(rows: DataFrame, keys: list[str], each: int = 3) -> DataFrame:
    """``keys, id``: the last ``each`` rows cited left of a boundary and the first right of it; where neither side cites any, the two rows on each side of the middle.

    ``rows`` has ``id, pos, of_left, of_right``; keys name the batch.
    """
    by = Window.partitionBy(*keys)
    left = F.sum(F.col("of_left").cast("int")).over(by.orderBy(F.desc("pos")))
    right = F.sum(F.col("of_right").cast("int")).over(by.orderBy("pos"))
    cited = (F.col("of_left") & (left <= each)) | (F.col("of_right") & (right <= each))
    middle = F.floor(F.count("*").over(by) / 2)
    near = (F.row_number().over(by.orderBy("pos")) - 1).between(middle - 2, middle + 1)
    return rows.withColumns({"cited": cited, "any": F.bool_or(F.col("of_left") | F.col("of_right")).over(by), "near": near}).where("cited OR NOT any AND near").select(*keys, "id")


def without_fields(column: str, fields: list[str]) -> Column:
    """An array of structs without some of their fields."""
    return F.transform(column, lambda x: x.dropFields(*fields))


def within(chunk: str, values: str) -> Column:
    """The elements of ``values`` that ``chunk`` has too, in order, once."""
    return F.array_intersect(values, chunk)


def local_or_nearest(times: str, low: Column, high: Column) -> Column:
    """The times of an array within ``low`` and ``high``, or the one nearest to their middle if none is; of two as near the earlier in the array."""
    local = F.filter(times, lambda t: t.between(low, high))
    middle = (low + high) / 2
    known = F.filter(times, lambda t: t.isNotNull())
    nearest = F.array_min(F.transform(known, lambda t, i: F.struct(F.abs(t - middle).alias("d"), i.alias("i"), t.alias("t"))))
    return F.when(F.size(local) > 0, local).when(F.size(known) > 0, F.array(nearest["t"])).otherwise(local)


# ---------------------------------------------------------------- putting together
def concatenated(parts: DataFrame, keys: list[str], order: str, rows: str, notes: str) -> DataFrame:
    """``keys, rows, notes``: the array columns of an entity's parts in order; repeated notes once, rows as they are. Parts of an entity are bounded."""
    listed = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, F.coalesce(rows, F.array().cast("array<string>")).alias("r"), F.coalesce(notes, F.array().cast("array<string>")).alias("u")))).alias("l"))
    return listed.select(*keys, F.flatten(F.transform("l", lambda x: x["r"])).alias(rows), F.array_distinct(F.flatten(F.transform("l", lambda x: x["u"]))).alias(notes))


def assembled(outline: DataFrame, notes: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, section, blocks, missing``: per section of the outline (``section, place, episode``) how many blocks its episodes (``episode, blocks``) bring, and which have no notes, in order."""
    rows = null_safe_join(outline, notes.select(*keys, "episode", "blocks"), [*keys, "episode"], "left")
    listed = F.sort_array(F.collect_list(F.when(F.col("blocks").isNull(), F.struct("place", "episode"))))
    return rows.groupBy(*keys, "section").agg(F.coalesce(F.sum("blocks"), F.lit(0)).alias("blocks"), F.transform(listed, lambda x: x["episode"]).alias("missing"))


def with_headers(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``header``: the subsection of a row where it opens one and its section has more than one, else null. ``rows`` has ``place, subsection``; keys name the section."""
    by = Window.partitionBy(*keys)
    several = F.min("subsection").over(by) != F.max("subsection").over(by)
    first = F.row_number().over(Window.partitionBy(*keys, "subsection").orderBy("place")) == 1
    return rows.withColumn("header", F.when(several & first, F.col("subsection")))


def anchors(episodes: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, place, id``: one anchor per episode (``id, s, e``), in order of time."""
    return with_position(episodes.where("s IS NOT NULL"), keys, "s", ["e", "id"], name="place").select(*keys, "place", "id")


def sample_offsets(window: Column, period: Column, most: int) -> Column:
    """Offsets around 0 over ``[-window, window]``, an odd number of three or more: as many as the period gives, at most ``most``."""
    n = F.greatest(F.lit(3), F.least(F.floor(2 * window / period).cast("int") + 1, F.lit(most)))
    n = F.greatest(F.lit(3), n - (1 - n % 2))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: -window + i * (2 * window / (n - 1)))


def delta_records(added: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, id, kind, text, latex, confidence``: what a window newly shows, as records numbered in order; only whole lines count.

    ``added`` has ``window, place, complete, text, latex, legibility``.
    """
    rows = added.where("complete")
    n = F.row_number().over(Window.partitionBy(*keys, "window").orderBy("place")) - 1
    formula = F.when(F.trim("latex") != "", F.trim("latex"))
    sure = F.coalesce(*[F.when(F.col("legibility") == k, F.lit(v)) for k, v in LEGIBLE.items()])
    return rows.select(*keys, F.concat(F.lit("obs_"), "window", F.lit("_"), F.lpad(n.cast("string"), 3, "0")).alias("id"), F.when(formula.isNotNull(), "equation").otherwise("remark").alias("kind"), F.trim("text").alias("text"), formula.alias("latex"), sure.alias("confidence"))


def distinct_times(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """``keys, at_ms, at``: times not below 0, one of those that round to the same millisecond: the smallest."""
    clamped = F.greatest(F.lit(0.0), F.col(at))
    return df.where(F.col(at).isNotNull()).groupBy(*keys, F.bround(clamped * 1000).cast("bigint").alias("at_ms")).agg(F.min(clamped).alias("at"))


def renamed(text: Column, names: list[tuple[str, str]]) -> Column:
    """A text with names replaced one after another, as they are written."""
    for old, new in names:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def candidate_sets(records: DataFrame, drafts: DataFrame, keys: list[str], most: int) -> DataFrame:
    """``keys, id, candidate, score, source``: the reading of a record, distinct other drafts up to ``most`` in all, and none.

    ``records`` has ``id, content, confidence``, ``drafts`` ``id, place, content, score``. A draft that repeats the record's reading raises its
    score; of drafts that repeat one another the first counts. Without drafts the scores follow from the confidence.
    """
    source = records.select(*keys, "id", F.col("content").alias("_own"), "confidence")
    own = null_safe_join(drafts, source.drop("confidence"), [*keys, "id"]).withColumn("_same", F.col("content").eqNullSafe(F.col("_own")))
    raised = own.where("_same").groupBy(*keys, "id").agg(F.max("score").alias("_raised"))
    scored = null_safe_join(source, raised, [*keys, "id"], "left")
    kept = scored.select(*keys, "id", F.concat("id", F.lit(":source")).alias("candidate"), F.greatest(2 * F.col("confidence") - 1, F.col("_raised")).alias("score"), F.lit("source").alias("source"))
    others = own.where("NOT _same").groupBy(*keys, "id", "content").agg(F.min("place").alias("place"), F.min_by("score", "place").alias("score"))
    others = others.withColumn("n", F.row_number().over(Window.partitionBy(*keys, "id").orderBy("place"))).where(F.col("n") <= most - 2)
    drawn = others.select(*keys, "id", F.concat("id", F.lit(":model"), F.col("place").cast("string")).alias("candidate"), "score", F.lit("model").alias("source"))
    none = source.select(*keys, "id", F.concat("id", F.lit(":null")).alias("candidate"), (-0.15 - 0.7 * F.col("confidence")).alias("score"), F.lit("null").alias("source"))
    return kept.unionByName(drawn).unionByName(none)


# ---------------------------------------------------------------- what may stand
def corrected(blocks: DataFrame, corrections: DataFrame, keys: list[str], least: float) -> DataFrame:
    """``keys, block_no, latex, fixes, outcome``: blocks under the corrections of their places, the last that applies counting, and a row of ``outcome`` for each correction that does not.

    ``corrections`` has ``block_no, latex, confidence, place``. One below ``least``, one of a block that does not exist and an empty one are told
    as such; one that changes nothing but white space is passed over.
    """
    now = blocks.select(*keys, "block_no", F.col("latex").alias("_now"), F.lit(True).alias("_there"))
    judged = null_safe_join(corrections, now, [*keys, "block_no"], "left")
    outcome = F.when(F.col("_there").isNull(), "no such block").when(~F.coalesce(F.col("confidence") >= least, F.lit(False)), "not sure enough").when(F.coalesce(F.trim("latex"), F.lit("")) == "", "empty").when(F.trim("latex").eqNullSafe(F.trim("_now")), "same").otherwise("applied")
    judged = staged(judged.withColumn("outcome", outcome), "corrections")
    last = judged.where("outcome = 'applied'").groupBy(*keys, "block_no").agg(F.max_by("latex", "place").alias("_new"), F.count("*").alias("fixes"))
    whole = null_safe_join(blocks, last, [*keys, "block_no"], "left").select(*keys, "block_no", F.coalesce("_new", "latex").alias("latex"), F.coalesce("fixes", F.lit(0)).alias("fixes"), F.lit(None).cast("string").alias("outcome"))
    return whole.unionByName(judged.where("outcome NOT IN ('applied', 'same')").select(*keys, "block_no", "latex", F.lit(0).cast("bigint").alias("fixes"), "outcome"))


def transaction_fault(action: Column, text: Column, latex: Column, reason: Column, refs: Column) -> Column:
    """Why a patch of a record is no patch, or null: to keep or replace takes a text, to keep no formula, to replace or reject a reason and references, to reject nothing else."""
    keeps, rejects, blank = action == "keep", action == "reject", F.coalesce(F.trim(reason), F.lit("")) == ""
    return F.when(action.isin("keep", "replace") & text.isNull(), "text missing").when(keeps & latex.isNotNull(), "formula with keep").when(~keeps & blank, "reason missing").when(~keeps & (F.coalesce(F.size(refs), F.lit(0)) <= 0), "references missing").when(rejects & (text.isNotNull() | latex.isNotNull()), "content with reject")


def patch_status(action: Column, latex: Column, new_latex: Column, refs: Column, allowed: Column, direct: Column) -> Column:
    """``kept``, ``replaced``, ``rejected`` or ``unresolved``: a change must cite only what is allowed, something direct, and may not drop a formula."""
    foreign = F.size(F.array_except(refs, allowed)) > 0
    drops = (F.trim(latex) != "") & new_latex.isNotNull() & (F.trim(new_latex) == "")
    return F.when(action == "keep", "kept").when(foreign | ~F.arrays_overlap(refs, direct), "unresolved").when(action == "reject", "rejected").when(F.coalesce(drops, F.lit(False)), "unresolved").otherwise("replaced")


def support(said: Column, sources: Column) -> Column:
    """The support that was said or, where that is uncertain, the one that the cited sources amount to."""
    cited = F.array_sort(F.array_distinct(sources))
    is_ = lambda *names: cited == F.array(*map(F.lit, sorted(names)))
    return F.when(said != "uncertain", said).when(is_("visual"), "visual").when(is_("transcript"), "transcript").when(is_("visual", "transcript"), "combined").otherwise("uncertain")


def marked_unsafe(ids: Column, prefixes: tuple[str, ...], least: float = 0.8) -> Column:
    """Whether the first id with one of the prefixes and a number after it has a number of ``least`` or more."""
    number = lambda x: F.coalesce(*[F.when(F.startswith(x, F.lit(p)), F.substring(x, len(p) + 1, 64).try_cast("double")) for p in prefixes])
    numbers = F.filter(F.transform(ids, number), lambda v: v.isNotNull())
    return F.coalesce(F.try_element_at(numbers, F.lit(1)) >= least, F.lit(False))


def eligible(evidence: DataFrame, used: DataFrame, keys: list[str], kinds: tuple[str, ...], least: float) -> DataFrame:
    """Evidence (``asset, kind, confidence, id``) with an asset that is not ``used``, of the kinds and sure enough, with ``rank`` by confidence."""
    rows = evidence.where((F.col("asset") != "") & F.col("kind").isin(*kinds) & (F.col("confidence") >= least))
    free = null_safe_join(rows, used.select(*keys, "asset").distinct(), [*keys, "asset"], "left_anti")
    return free.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("confidence"), "id")))


def replacements(unsafe: DataFrame, free: DataFrame, keys: list[str], quota: int) -> DataFrame:
    """``keys, block_id, asset``: unsafe blocks (``id, place``) with the asset that takes their place, the n-th block the n-th best, up to the quota; the others get null and go. Keys name the batch."""
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy("place", "id"))
    rows = unsafe.select(*keys, F.col("id").alias("block_id"), turn.alias("rank"))
    return null_safe_join(rows, free.where(F.col("rank") <= quota).select(*keys, "rank", "asset"), [*keys, "rank"], "left").select(*keys, "block_id", "asset")


def demoted(blocks: DataFrame, pattern: str, text: str) -> DataFrame:
    """Adds ``speculative``: whether the text matches the pattern; null texts do not."""
    return blocks.withColumn("speculative", F.coalesce(F.col(text).rlike(pattern), F.lit(False)))


def plan_faults(items: DataFrame, allowed: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, place, fault``: items of a plan (``place, kind, cited, is_formula``) that cite what is not ``allowed`` (``id, latex``), say in prose what is no statement, or select a formula that is none."""
    cited = items.select(*keys, "place", "kind", "is_formula", F.explode_outer("cited").alias("id"))
    known = null_safe_join(cited, allowed.select(*keys, "id", F.trim("latex").alias("_latex"), F.lit(True).alias("_there")), [*keys, "id"], "left")
    foreign = F.col("_there").isNull() & F.col("id").isNotNull()
    fault = F.when(foreign, "cites what is not there").when(~F.col("is_formula") & F.col("kind").isin(*NO_STATEMENT), "no statement").when(F.col("is_formula") & (F.coalesce("_latex", F.lit("")) == ""), "no formula")
    return known.withColumn("fault", fault).where("fault IS NOT NULL").groupBy(*keys, "place").agg(F.min("fault").alias("fault"))


def canonical_groups(expected: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, id, pos, group_no``: the expected rows (``id, pos``) in groups of neighbours that the plan puts together; ``plan`` has ``block, place, id``.

    A block joins two neighbours only if it names each once in the whole plan, and all of its own such rows in the expected order. What is missing, repeated, unknown or
    out of order thus parts groups and never changes the order. Keys name the section.
    """
    named = null_safe_join(plan, expected.select(*keys, "id", "pos"), [*keys, "id"])
    once = named.withColumn("_n", F.count("*").over(Window.partitionBy(*keys, "id"))).where("_n = 1")
    inside = Window.partitionBy(*keys, "block").orderBy("place")
    once = once.withColumn("_before", F.lag("pos").over(inside)).withColumn("_ok", F.bool_and(F.coalesce(F.col("_before") < F.col("pos"), F.lit(True))).over(Window.partitionBy(*keys, "block")))
    joined = once.where("_ok AND pos = _before + 1").select(*keys, "id", F.lit(0).alias("_opens"))
    rows = null_safe_join(expected, joined, [*keys, "id"], "left").withColumn("_opens", F.coalesce("_opens", F.lit(1)))
    return rows.select(*keys, "id", "pos", (F.sum("_opens").over(Window.partitionBy(*keys).orderBy("pos")) - 1).alias("group_no"))


def block_faults(planned: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, foreign, missing, in_order``: per block how many ids its segments (``place, id``) cite that are not planned (``id, pos``), how many planned ones they lack, and whether the planned ones first appear in the planned order."""
    seen = segments.groupBy(*keys, "id").agg(F.min("place").alias("first"))
    plan = planned.select(*keys, "id", "pos").withColumn("_planned", F.lit(True))
    both = null_safe_join(plan, seen, [*keys, "id"], "left")
    ordered = both.withColumn("_before", F.max("first").over(Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)))
    own = ordered.groupBy(*keys).agg(F.count_if(F.col("first").isNull()).alias("missing"), F.bool_and(F.coalesce(F.col("first") > F.col("_before"), F.lit(True)) & F.col("first").isNotNull()).alias("in_order"))
    foreign = null_safe_join(seen, plan, [*keys, "id"], "left_anti").groupBy(*keys).agg(F.count("*").alias("foreign"))
    return null_safe_join(own, foreign, keys, "left").select(*keys, F.coalesce("foreign", F.lit(0)).alias("foreign"), "missing", "in_order")


def surviving(rows: DataFrame, column: str, alive: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (with ``id``) with only the references of ``column`` to ids that are ``alive``, in order, and ``active``: whether any is left."""
    each = rows.select(*keys, "id", F.posexplode(column).alias("_n", "_ref"))
    kept = null_safe_join(each, alive.select(*keys, F.col("id").alias("_ref")), [*keys, "_ref"], "left_semi").groupBy(*keys, "id").agg(F.sort_array(F.collect_list(F.struct("_n", "_ref"))).alias("_l"))
    out = null_safe_join(rows, kept, [*keys, "id"], "left").withColumn(column, F.coalesce(F.transform("_l", lambda x: x["_ref"]), F.array().cast("array<string>"))).drop("_l")
    return out.withColumn("active", F.size(column) > 0)


def closed(episodes: DataFrame) -> DataFrame:
    """Episodes with ``open`` as status ``closed``."""
    return episodes.withColumn("status", F.when(F.lower("status") == "open", "closed").otherwise(F.col("status")))


def routed(items: DataFrame, placed: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, id, section``: each item (``id, related``) with the sections of the placed rows (``id, section``) it relates to or, where there are none, the last section of its entity."""
    each = items.select(*keys, "id", F.explode("related").alias("_ref")).distinct()
    near = null_safe_join(each, placed.select(*keys, F.col("id").alias("_ref"), "section"), [*keys, "_ref"]).select(*keys, "id", "section").distinct()
    last = placed.groupBy(*keys).agg(F.max("section").alias("section"))
    rest = null_safe_join(items.select(*keys, "id"), near, [*keys, "id"], "left_anti")
    return near.unionByName(null_safe_join(rest, last, keys).select(*keys, "id", "section"))


def unique_matches(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, id, match``: rows of ``left`` (``id, content``) with the one row of ``right`` that has the same content; contents that several have, null and empty ones match nothing."""
    one = right.where("content <> ''").groupBy(*keys, "content").agg(F.min("id").alias("match"), F.count_distinct("id").alias("_n")).where("_n = 1")
    return null_safe_join(left.where("content <> ''"), one.drop("_n"), [*keys, "content"]).select(*keys, "id", "match")
