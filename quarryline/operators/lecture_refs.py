"""The references between the lecture tables, as batches for the orphan ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scan import united
from ..sources.tables import table
from .orphans import OrphanLedger, arrivals, clean_key, references

#: referring table, column, record, parent table
LINKS = (
    ("graph_edges", "source", "edge_id", "graph_nodes"),
    ("graph_edges", "target", "edge_id", "graph_nodes"),
    ("graph_nodes", "evidence_ids", "id", "observations"),
    ("linear_blocks", "source_segment_ids", "id", "transcript_segments"),
)
PARENTS = ("graph_nodes", "observations", "transcript_segments")


def reference_batch(spark: SparkSession, directory: str, since: str | None = None, until: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """References, parent arrivals and deletions with an arrival from ``since`` (incl.) to ``until`` (excl.)."""

    def cut(df: DataFrame, at: str) -> DataFrame:
        if since:
            df = df.where(F.col(at) >= F.lit(since).cast(df.schema[at].dataType))
        if until:
            # Rows without an arrival time belong to the first batch: they sort before everything.
            df = df.where((F.col(at) < F.lit(until).cast(df.schema[at].dataType)) | (F.col(at).isNull() if not since else F.lit(False)))
        return df

    refs = [references(cut(table(spark, directory, t, "lecture_id", r, f, "ingested_at"), "ingested_at"), t, f, p, "lecture_id", F.col(r), f) for t, f, r, p in LINKS]
    parents = [arrivals(cut(table(spark, directory, p, "lecture_id", "id", "ingested_at"), "ingested_at"), p, "lecture_id", "id") for p in PARENTS]
    log = cut(table(spark, directory, "deletion_log"), "deleted_at")
    deleted = log.select(F.trim("table_name").alias("parent_table"), F.col("lecture_id").alias("entity"), clean_key(F.col("record_id")).alias("ref_key"), F.col("deleted_at").cast("timestamp").alias("at"))
    return united(refs), united(parents), deleted


def lecture_ledger(spark: SparkSession, directory: str, cuts: tuple[str, ...] | None = None) -> OrphanLedger:
    """The ledger after all batches. Without ``cuts``, one batch of the backlog and one of the last tenth of the time."""
    if cuts is None:
        low, high = table(spark, directory, "graph_edges", "ingested_at").agg(*[F.unix_micros(f("ingested_at").cast("timestamp")) for f in (F.min, F.max)]).first()
        cuts = () if low is None or low == high else (str(spark.range(1).select(F.timestamp_micros(F.lit(low + (high - low) * 9 // 10)).cast("string")).first()[0]),)
    ledger, bounds = OrphanLedger(spark, buckets=16), [None, *cuts, None]
    for since, until in zip(bounds, bounds[1:]):
        ledger.advance(*reference_batch(spark, directory, since, until), last=until is None)
    return ledger
