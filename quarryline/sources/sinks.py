"""Rendered texts and audit rows, and what may be skipped on a rerun."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Environments of block types.
ENVIRONMENTS = ("definition", "theorem", "lemma", "proof", "example", "remark", "exercise")


def rendered(block_type: Column, title: Column, latex: Column) -> Column:
    """A block as TeX: a display for equations, an environment for its type, else a paragraph. A null body is empty."""
    body = F.coalesce(latex, F.lit(""))
    head = F.when(F.trim(title) != "", F.concat(F.lit("["), title, F.lit("]"))).otherwise("")
    inside = F.concat(F.lit("\\begin{"), block_type, F.lit("}"), head, F.lit("\n"), body, F.lit("\n\\end{"), block_type, F.lit("}"))
    return F.when(block_type == "equation", F.concat(F.lit("\\[\n"), body, F.lit("\n\\]"))).when(block_type.isin(*ENVIRONMENTS), inside).otherwise(body)


def write_texts(blocks: DataFrame, path: str, entity: str, order: list[str], text: str) -> None:
    """One folder of text per entity with its blocks in order.

    Rows are sorted within files that are ranges of (entity, order), so an entity larger than a task has several
    files whose names sort in order, and none is gathered into one string.
    """
    rows = blocks.repartitionByRange(entity, *order).sortWithinPartitions(entity, *order)
    rows.select(entity, F.col(text).alias("value")).write.mode("overwrite").partitionBy(entity).text(path)


def write_audit(rows: DataFrame, path: str, entity: str, *columns: str) -> None:
    """JSON rows of those with something in one of the array columns."""
    some = F.lit(False)
    for c in columns:
        some |= F.coalesce(F.size(c), F.lit(0)) > 0
    rows.where(some).write.mode("overwrite").partitionBy(entity).json(path)


def fingerprint(*columns: Column) -> Column:
    """A content hash: equal for equal contents, nulls told from empty texts."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]), 256)


def to_do(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys and ``fingerprint`` are not among the finished ones."""
    return rows.join(done.select(*keys, "fingerprint").distinct(), [*keys, "fingerprint"], "left_anti")


def unreferenced(files: DataFrame, references: DataFrame) -> DataFrame:
    """Files (``path``) that no reference (``path``) names."""
    return files.join(references.select("path").distinct(), "path", "left_anti")
