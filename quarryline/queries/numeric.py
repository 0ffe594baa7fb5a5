"""Arrays of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..sources.tables import table


def _vectors(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "embeddings", "vec_id", "embedding", "label").withColumn("v", F.transform("embedding", lambda x: x.cast("double")))


def robust_vectors(spark: SparkSession, directory: str) -> DataFrame:
    """Median and largest robust deviation of each vector."""
    v = _vectors(spark, directory)
    return v.select("vec_id", F.round(A.median(F.col("v")), 6).alias("median"), F.round(F.array_max(F.transform(A.robust(F.col("v")), F.abs)), 5).alias("deviation"))


def label_composites(spark: SparkSession, directory: str) -> DataFrame:
    """Median of each dimension over the vectors of a label."""
    v = _vectors(spark, directory).select("label", F.posexplode("v").alias("dimension", "x"))
    return v.groupBy("label", "dimension").agg(F.round(F.percentile("x", 0.5), 6).alias("median"))


def vector_changes(spark: SparkSession, directory: str) -> DataFrame:
    """How much each vector differs from the one before it."""
    v = _vectors(spark, directory)
    p = v.select((F.col("vec_id") + 1).alias("vec_id"), F.col("v").alias("w"))
    return v.join(p, "vec_id").select("vec_id", F.round(A.change(F.col("w"), F.col("v"), 8), 5).alias("change"))


def vector_runs(spark: SparkSession, directory: str) -> DataFrame:
    """Stretches of dimensions of at least 0.1, over holes of one."""
    v = _vectors(spark, directory)
    return v.select("vec_id", F.explode(A.runs(F.col("v"), 0.1, 1)).alias("r")).select("vec_id", "r.first", "r.last")


def crop_overlaps(spark: SparkSession, directory: str) -> DataFrame:
    """Crops at one moment that overlap, with intersection over union."""
    c = table(spark, directory, "formula_crops", "lecture_id", "id", "ts_sec", "bbox").withColumn("lecture_id", F.lower(F.trim("lecture_id"))).distinct().where("ts_sec IS NOT NULL AND size(bbox) = 4")
    o = c.select("lecture_id", "ts_sec", F.col("id").alias("other_id"), F.col("bbox").alias("other"))
    pairs = c.join(o, ["lecture_id", "ts_sec"]).where("id < other_id").withColumn("iou", A.iou(F.col("bbox"), F.col("other")))
    return pairs.where("iou > 0").select("lecture_id", "id", "other_id", F.round("iou", 6).alias("iou"))


def crop_tiles(spark: SparkSession, directory: str) -> DataFrame:
    """Each crop's width cut into three tiles that share a tenth."""
    c = table(spark, directory, "formula_crops", "lecture_id", "id", "bbox").withColumn("lecture_id", F.lower(F.trim("lecture_id"))).distinct().where("size(bbox) = 4")
    return c.select("lecture_id", "id", F.posexplode(A.tiles((F.get("bbox", F.lit(2)) - F.get("bbox", F.lit(0))).cast("double"), 3, 0.1)).alias("tile", "t")).select("lecture_id", "id", "tile", "t.first", "t.last")


QUERIES = {f.__name__: f for f in (robust_vectors, label_composites, vector_changes, vector_runs, crop_overlaps, crop_tiles)}
_V = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)"
_B = "SELECT DISTINCT lower(trim(lecture_id)) AS lecture_id, id, ts_sec, bbox FROM formula_crops WHERE len(bbox) = 4"
SQL = {
    "robust_vectors": f"WITH {_V}, m AS (SELECT vec_id, v, list_aggregate(v, 'median') AS m FROM v), d AS (SELECT vec_id, m, v, list_aggregate(list_transform(v, lambda x: abs(x - m)), 'median') AS d FROM m) SELECT vec_id, round(m, 6) AS median, round(list_max(list_transform(v, lambda x: least(6.0, abs(x - m) / greatest(0.04, 1.4826 * d)))), 5) AS deviation FROM d",
    "vector_changes": f"WITH {_V}, d AS (SELECT a.vec_id, list_transform(list_zip(b.v, a.v), lambda p: abs(p[1] - p[2])) AS d FROM v a JOIN v b ON a.vec_id = b.vec_id + 1), m AS (SELECT *, list_reverse_sort(list_transform(range(0, 8), lambda i: list_avg(d[i * 8 + 1 : i * 8 + 8]))) AS m FROM d) SELECT vec_id, round(0.45 * list_avg(d) + 0.35 * list_avg(m[1:4]) + 0.20 * list_sort(d)[63], 5) AS change FROM m",
    "label_composites": f"WITH {_V}, x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS dimension FROM v) SELECT label, dimension, round(median(x), 6) AS median FROM x GROUP BY 1, 2",
    "crop_overlaps": f"WITH c AS ({_B} AND ts_sec IS NOT NULL), p AS (SELECT a.lecture_id, a.id, b.id AS other_id, greatest(0, least(a.bbox[3], b.bbox[3]) - greatest(a.bbox[1], b.bbox[1])) * greatest(0, least(a.bbox[4], b.bbox[4]) - greatest(a.bbox[2], b.bbox[2])) AS i, greatest(1, a.bbox[3] - a.bbox[1]) * greatest(1, a.bbox[4] - a.bbox[2]) + greatest(1, b.bbox[3] - b.bbox[1]) * greatest(1, b.bbox[4] - b.bbox[2]) AS s FROM c a JOIN c b ON a.lecture_id = b.lecture_id AND a.ts_sec = b.ts_sec AND a.id < b.id) SELECT lecture_id, id, other_id, round(i / (s - i), 6) AS iou FROM p WHERE i > 0",
    "crop_tiles": f"WITH c AS ({_B}), x AS (SELECT lecture_id, id, unnest(range(0, 3)) AS tile, (bbox[3] - bbox[1]) / 2.8 AS w FROM c) SELECT DISTINCT lecture_id, id, tile, round(tile * w * 0.9, 3) AS first, round(tile * w * 0.9 + w, 3) AS last FROM x",
}
