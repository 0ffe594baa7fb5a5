"""Results written once to the folder that all executors share, and read again.

Cutting the lineage with a written table keeps only the columns needed, compressed, and survives the loss of
executors. The folder is the session's ``spark.checkpoint.dir``; one is made only where that is unset (tests).
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_written: list[tuple[SparkSession, str]] = []
_path_of: dict[int, tuple] = {}


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, set to a temporary one only in local mode without any."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='quarryline-')}"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back with the same schema."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    read = spark.read.schema(df.schema).parquet(path)
    _path_of[id(read)] = (weakref.ref(read), path)
    return read


def release(df: DataFrame) -> None:
    """Delete the table behind a frame that ``staged`` gave and nothing reads any more; other frames are let be."""
    of, path = _path_of.pop(id(df), (lambda: None, ""))
    if of() is df and path:
        _delete(df.sparkSession, path)
        _written.remove((df.sparkSession, path))


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Buckets:
    """A table in buckets, of which a write replaces only those it names.

    Every write goes to a folder of its own; which folder holds a bucket's rows now is kept here, at most a path per bucket.
    Rows have an INT ``bucket``. Large buckets are written by several tasks.
    """

    def __init__(self, spark: SparkSession, name: str, schema: str):
        self.spark, self.name, self.schema = spark, name, StructType.fromDDL(schema)
        self.held: dict[int, str] = {}

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of some buckets, or of all."""
        paths = [self.held[b] for b in sorted(self.held if buckets is None else set(buckets) & set(self.held))]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def replace(self, rows: DataFrame, buckets: Iterable[int]) -> None:
        """The named buckets now hold ``rows``; all others stay."""
        path = f"{shared_folder(self.spark)}/{self.name}-{uuid.uuid4().hex}"
        rows.hint("rebalance", "bucket").withColumn("in", F.col("bucket")).write.partitionBy("in").parquet(path)
        _written.append((self.spark, path))
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        listed = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
        made = {int(n[3:]) for n in (f.getPath().getName() for f in listed) if n.startswith("in=")}
        for b in buckets:
            self.held.pop(b, None)
        self.held |= {b: f"{path}/in={b}" for b in made}


@atexit.register
def _drop() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone, and its folder with it
            return
