"""Labelling a stream of points with fitted centres.

The reference has no stream; this module only lets the stateless operators
(validation, nearest-centre assignment P10, origin shift against a known
origin) run on ``readStream`` input.  They are column expressions, so the
streaming plan is the batch plan: no state, no watermark, nothing kept
between micro-batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from locus.functions.distance import Center, nearest
from locus.sources.points import valid_points

POINT_SCHEMA = T.StructType([
    T.StructField("point_id", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])


def read_point_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                      schema: T.StructType = POINT_SCHEMA,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def label_stream(points: DataFrame, centers: Sequence[Center], x: str = "x",
                 y: str = "y") -> DataFrame:
    """Add ``center_id``, ``cx``, ``cy`` and ``d2`` of the nearest centre."""
    near = nearest(F.col(x), F.col(y), centers, coords=True)
    return (valid_points(points, x, y).withColumn("_n", near)
            .select("*", F.col("_n.center_id").alias("center_id"), F.col("_n.cx").alias("cx"),
                    F.col("_n.cy").alias("cy"), F.col("_n.d2").alias("d2"))
            .drop("_n"))


def start_labelling(points: DataFrame, centers: Sequence[Center], sink_path: str,
                    checkpoint: str, fmt: str = "parquet", trigger_once: bool = False):
    """Append labelled points to ``sink_path``; progress in ``checkpoint``
    (a folder in the shared checkpoint location, so a restarted query
    resumes without relabelling)."""
    w = (label_stream(points, centers).writeStream.format(fmt).outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
