"""Set operations and duplicates: fuzzy reconciliation, exact duplicates with protected rows, consensus of states."""

from __future__ import annotations

from collections.abc import Iterable
from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import fold_islands

#: From what score on records are one, the score of equal wording, and the weights of time and wording.
MERGE_AT, EXACT_AT, TIME_SHARE, TEXT_SHARE = 0.78, 0.95, 0.45, 0.55


def squeezed(text: str | None) -> str:
    return "".join((text or "").split()).lower()


def ratio(a: str, b: str, least: float = 0.0) -> float:
    """Matching-block ratio of two squeezed texts; 0 if either is empty or if bounds show that it is below ``least``."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    m = SequenceMatcher(None, a, b)
    return m.ratio() if m.real_quick_ratio() >= least and m.quick_ratio() >= least else 0.0


class Reading:
    """A record as it is compared: its span, how sure it is, and its wordings with what likeness needs of them."""

    def __init__(self, row: dict):
        self.start, self.end, self.sure = row["s"], row["e"], row["confidence"]
        self.worded(row["text"], row["latex"])

    def worded(self, text: str | None, formula: str | None) -> None:
        self.text, self.formula = text, formula
        self.keys = squeezed(formula), squeezed(text)
        self.bag = frozenset("".join(c if c.isalnum() or c in "_\\" else " " for c in (text or "").lower()).split())

    def likeness(self, other: Reading, least: float = 0.0) -> float:
        """How surely two readings are of one event; 0 where it is certain to be below ``least``."""
        equal = EXACT_AT if any(x and x == y for x, y in zip(self.keys, other.keys)) else 0.0
        common = min(self.end, other.end) - max(self.start, other.start)
        if common <= 0:
            return equal
        time = TIME_SHARE * min(1.0, common / max(1e-3, min(self.end - self.start, other.end - other.start)))
        wanted = (max(least, equal) - time) / TEXT_SHARE
        if wanted > 1:
            return equal
        union = len(self.bag | other.bag)
        wording = max(len(self.bag & other.bag) / union if self.bag and other.bag else 0.0, *(ratio(x, y, wanted) for x, y in zip(self.keys, other.keys)))
        return max(equal, time + TEXT_SHARE * wording)

    def take(self, other: Reading) -> None:
        """Stand for another reading too: cover its span, be as sure as the surer, and use its wording where that is longer and as sure."""
        self.start, self.end, self.sure = min(self.start, other.start), max(self.end, other.end), max(self.sure, other.sure)
        if other.sure == self.sure:
            longer = len((other.text or "").strip()) > len((self.text or "").strip())
            fuller = bool(other.formula) and len(other.formula) >= len(self.formula or "")
            self.worded(other.text if longer else self.text, other.formula if fuller else self.formula)


def reconcile_rows(rows: Iterable[dict]) -> list[tuple[int, Reading]]:
    """For each record, in order of time, the place of the one that stands for it, and that one's reading at the end.

    A record joins the standing one it is most like, the earlier on a tie, or stands for itself. Only records that still
    reach into the time of the one at hand are compared, so the work follows how many run at once, not how many there are.
    """
    standing: list[tuple[int, Reading]] = []
    running: list[int] = []  # of those that may still touch later records
    stands_for: list[int] = []
    for place, row in enumerate(rows):
        reading = Reading(row)
        running = [i for i in running if standing[i][1].end >= reading.start]
        scores = [(standing[i][1].likeness(reading, MERGE_AT), -i) for i in running if standing[i][1].start <= reading.end]
        score, chosen = max(scores, default=(0.0, 0))
        if score >= MERGE_AT:
            standing[-chosen][1].take(reading)
            stands_for.append(-chosen)
        else:
            running.append(len(standing))
            stands_for.append(len(standing))
            standing.append((place, reading))
    return [standing[i] for i in stands_for]


def reconcile(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, id, canonical_id, s, e, confidence``: observations merged with earlier ones that are nearly the same.

    ``df`` has ``id, s, e, text, latex, confidence``; keys name the entity and kind. Records are taken in order of
    (s, e, id). Only records whose intervals touch can merge, and merging never leaves the stretch that touching
    intervals cover, so each stretch is reconciled by itself, exactly. Rows with null or reversed times stay as they are.
    """
    columns = [*keys, "id", "s", "e", "text", "latex", "confidence"]
    rows = df.select(*columns).withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    typed = ", ".join(f"`{k}` string" for k in keys)

    def fold(part: list[dict], final: bool) -> list[dict]:
        found = zip(part, reconcile_rows(part))
        return [{**{k: r[k] for k in keys}, "id": r["id"], "canonical_id": part[first]["id"], "s": whole.start, "e": whole.end, "confidence": whole.sure} for r, (first, whole) in found]

    schema = f"{typed}, id string, canonical_id string, s bigint, e bigint, confidence double"
    usable = F.col("s") <= F.col("e")
    done = fold_islands(rows.where(usable), keys, "s", "e", ["e", "id"], 1, fold, schema)
    rest = rows.where(~usable | usable.isNull()).select(*keys, "id", F.col("id").alias("canonical_id"), "s", "e", "confidence")
    return done.unionByName(rest)


def exact_duplicates(df: DataFrame, keys: list[str], pos: str, content: Column, protected: Column, long_enough: Column) -> DataFrame:
    """Adds ``kept_id``: the row that stands for a row. Rows equal in keys and content collapse into the first.

    A protected row is always kept and becomes the one that later rows collapse into. Rows that are not long
    enough stand for themselves.
    """
    rows = df.withColumns({"_c": F.sha2(content, 256), "_p": protected, "_l": long_enough})
    first = Window.partitionBy(*keys, "_c").orderBy(pos, "id").rowsBetween(Window.unboundedPreceding, 0)
    head = F.row_number().over(Window.partitionBy(*keys, "_c").orderBy(pos, "id")) == 1
    long_rows = rows.where("_l").withColumn("_h", head)
    stand = F.last(F.when(F.col("_h") | F.col("_p"), F.col("id")), ignorenulls=True).over(first)
    collapsed = long_rows.withColumn("kept_id", stand).drop("_h")
    alone = rows.where("NOT _l OR _l IS NULL").withColumn("kept_id", F.col("id"))
    return collapsed.unionByName(alone).drop("_c", "_p", "_l")


def consensus(states: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """Rows that every state has with the same content: ``keys, content``; ``states`` has a ``state_id``."""
    n = states.select("state_id").distinct().count()
    return states.groupBy(*keys, *content).agg(F.count_distinct("state_id").alias("_n")).where(F.col("_n") == n).drop("_n")


def divergent(states: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """Keys on which states differ, or that some lack: ``keys, versions, states``."""
    n = states.select("state_id").distinct().count()
    seen = states.groupBy(*keys).agg(F.count_distinct(F.struct(*content)).alias("versions"), F.count_distinct("state_id").alias("states"))
    return seen.where((F.col("versions") > 1) | (F.col("states") < n))
