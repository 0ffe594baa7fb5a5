"""References to records that do not exist, kept up to date as records arrive and are deleted.

``OrphanLedger`` holds three keyed tables: the parent index (first and last arrival and last deletion of each key), the
references that wait (orphans), and those that are held. ``advance`` takes one batch of arrivals: new references probe the
index, arriving parents resolve waiting references, deletions reopen held ones. The tables lie in buckets of keys, a few
for each entity, and a batch reads and writes only the buckets that its keys fall into, so its cost follows the entities it
concerns, not the history. ``snapshot`` counts per table and period, ``snapshots`` keeps such counts from batch to batch. Batches may
be cut anywhere: the result is the same as for one batch of everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scan import united
from ..plans.skew import split_hot_join
from ..plans.staging import Buckets, staged

KEY = ["parent_table", "entity", "ref_key"]
REF = ["ref_table", "ref_field", "record_id", *KEY]
MISSING, LATE, DELETED, HELD = "missing", "late", "deleted", "held"

_INDEX = "parent_table string, entity string, ref_key string, first_at timestamp, last_at timestamp, deleted_at timestamp"
_REFS = "ref_table string, ref_field string, record_id string, parent_table string, entity string, ref_key string, ref_at timestamp, status string"
_COUNTS = "batch int, ref_table string, ref_field string, period timestamp, orphans bigint, missing bigint, late bigint, deleted bigint"


def clean_key(column: Column) -> Column:
    """A key without outer spaces; null for an empty one, which is no reference."""
    bare = F.regexp_replace(column, r"^[\s ]+|[\s ]+$", "")
    return F.when(bare != "", bare)


def references(df: DataFrame, ref_table: str, ref_field: str, parent_table: str, entity: str, record: Column, key: str, arrival: str = "ingested_at") -> DataFrame:
    """References of one column (STRING or ARRAY<STRING>), one row each, null and empty ones left out."""
    keys = F.col(key)
    if df.schema[key].dataType.typeName() == "array":
        keys = F.explode(F.array_distinct(F.transform(keys, clean_key)))
    else:
        keys = clean_key(keys)
    rows = df.select(record.cast("string").alias("record_id"), F.col(entity).alias("entity"), F.col(arrival).cast("timestamp").alias("ref_at"), keys.alias("ref_key"))
    rows = rows.where("ref_key IS NOT NULL")
    return rows.select(F.lit(ref_table).alias("ref_table"), F.lit(ref_field).alias("ref_field"), "record_id", F.lit(parent_table).alias("parent_table"), "entity", "ref_key", "ref_at")


def arrivals(df: DataFrame, parent_table: str, entity: str, key: str, arrival: str = "ingested_at") -> DataFrame:
    """Arrivals of keys of a parent table."""
    return df.select(F.lit(parent_table).alias("parent_table"), F.col(entity).alias("entity"), clean_key(F.col(key)).alias("ref_key"), F.col(arrival).cast("timestamp").alias("at")).where("ref_key IS NOT NULL")


def _status() -> Column:
    gone = F.col("deleted_at").isNotNull() & (F.col("last_at").isNull() | (F.col("last_at") <= F.col("deleted_at")))
    return F.when(F.col("first_at").isNull(), MISSING).when(F.col("first_at") > F.col("ref_at"), LATE).when(gone, DELETED).otherwise(HELD)


class OrphanLedger:
    """Pending-orphan state over batches. A reference is an orphan while its status is not ``held``:

    ``missing``: no row has the key; ``late``: the key arrived after the reference first did (it waited, and stays
    listed as having been dangling); ``deleted``: the key was deleted and no row of it arrived after that. A null entity is an
    entity like any other. A reference repeated in any batches counts once, from its first arrival.

    An entity's keys are spread over ``spread`` of the ``buckets``; choose their number so that a bucket has a few GB.
    Every ``snapshot_every`` batches the counts per month are kept (0: never).
    """

    def __init__(self, spark: SparkSession, hot_rows: int = 500_000, buckets: int = 64, spread: int = 4, snapshot_every: int = 0):
        self.spark, self.hot_rows, self.buckets, self.spread, self.snapshot_every = spark, hot_rows, buckets, spread, snapshot_every
        self.index = Buckets(spark, "parents", f"{_INDEX}, bucket int")
        self.waiting = Buckets(spark, "waiting", f"{_REFS}, bucket int")
        self.held = Buckets(spark, "held", f"{_REFS}, bucket int")
        self.last: DataFrame | None = None  # the orphans of the batch that was not written
        self.touched: set[int] = set()  # buckets of the last batch
        self.batches = 0
        self.kept: list[DataFrame] = []

    def _bucket(self) -> Column:
        part = F.pmod(F.xxhash64("ref_key"), F.lit(self.spread))
        return F.pmod(F.xxhash64(F.coalesce("entity", F.lit("")), part), F.lit(self.buckets)).cast("int").alias("bucket")

    def advance(self, new_refs: DataFrame, new_parents: DataFrame, deletions: DataFrame, last: bool = False) -> OrphanLedger:
        """Take one batch: references (`references`), parent arrivals and deletions (`arrivals`).

        With ``last`` the new state is left as a plan instead of being written, and no batch can follow.
        """
        if self.last is not None:
            raise RuntimeError("the last batch was taken")
        nothing = F.lit(None).cast("timestamp")
        seen = new_parents.groupBy(*KEY).agg(F.min("at").alias("first_at"), F.max("at").alias("last_at")).withColumn("deleted_at", nothing)
        dropped = deletions.groupBy(*KEY).agg(F.max("at").alias("deleted_at")).select(*KEY, nothing.alias("first_at"), nothing.alias("last_at"), "deleted_at")
        fresh = new_refs.groupBy(*REF).agg(F.min("ref_at").alias("ref_at"))
        first = not self.batches
        if first and last:
            self.touched = set(range(self.buckets))
            delta, fresh = seen.unionByName(dropped).withColumn("bucket", self._bucket()), fresh.withColumn("bucket", self._bucket())
        else:
            delta, fresh = staged(seen.unionByName(dropped).withColumn("bucket", self._bucket()), "arrived-parents"), staged(fresh.withColumn("bucket", self._bucket()), "arrived")
            self.touched = {r[0] for r in delta.select("bucket").unionByName(fresh.select("bucket")).distinct().collect()}  # at most the number of buckets
        known = delta if first else self.index.read(self.touched).unionByName(delta)
        index = known.groupBy("bucket", *KEY).agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), F.max("deleted_at").alias("deleted_at"))
        if not last:
            self.index.replace(index, self.touched)
            index = self.index.read(self.touched)
        if first:
            refs = counted = fresh
        else:
            refs = self.waiting.read(self.touched).unionByName(self.held.read(self.touched)).drop("status").unionByName(fresh)
            counted = refs.select(*KEY)
            refs = refs.groupBy("bucket", *REF).agg(F.min("ref_at").alias("ref_at"))
        judged = split_hot_join(refs, index.drop("bucket"), KEY, self.hot_rows, counted=counted).withColumn("status", _status())
        judged = judged.select(*REF, "ref_at", "status", "bucket")
        if last:
            orphans, untouched = judged.where(F.col("status") != HELD), set(range(self.buckets)) - self.touched
            self.last = orphans.unionByName(self.waiting.read(untouched)) if untouched & set(self.waiting.held) else orphans
        else:
            judged = staged(judged, "judged")
            self.waiting.replace(judged.where(F.col("status") != HELD), self.touched)
            self.held.replace(judged.where(F.col("status") == HELD), self.touched)
        self.batches += 1
        if self.snapshot_every and self.batches % self.snapshot_every == 0:
            self.kept.append(staged(self.snapshot().select(F.lit(self.batches).alias("batch"), "*"), "snapshot"))
        return self

    def orphans(self) -> DataFrame:
        """The references whose status is not ``held``."""
        return (self.waiting.read() if self.last is None else self.last).drop("bucket")

    def snapshot(self, period: str = "month") -> DataFrame:
        """Orphans per referring table, field and period of the reference's arrival, by status."""
        rows = self.orphans().withColumn("period", F.date_trunc(period, "ref_at"))
        return rows.groupBy("ref_table", "ref_field", "period").agg(F.count("*").alias("orphans"), *[F.count_if(F.col("status") == s).alias(s) for s in (MISSING, LATE, DELETED)])

    def snapshots(self) -> DataFrame:
        """The snapshots kept so far, with the number of the batch after which they were taken."""
        return united(self.kept) if self.kept else self.spark.createDataFrame([], _COUNTS)
