"""Point sets derived from the input tables (FIXTURES.md section 3).

* PT  - ``(p_size*1000, round((p_retailprice-900)*500))`` of every ``part`` row,
        with ``point_id`` = rank over (x, y, p_partkey); rows at one place stay.
* PTD - the distinct points of PT, with ``point_id`` = rank over (x, y): the set that
        neighbourhoods are defined on.
* LT  - ``(l_quantity*1000, floor(l_extendedprice))`` of every ``lineitem`` row.
* LTW - LT collapsed to distinct points with a weight (row count) and an id:
        duplicates cost one row however many copies there are, so a point
        repeated in a third of the table is one weighted row, not a hot key.
* BP  - ``part`` points tagged with ``p_brand`` (a grouping for per-group work).

Integer-valued coordinates keep sums and squared distances exact in every
engine, so results can be compared value for value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from locus.operators.ids import with_sequential_id
from locus.runtime import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _part_xy() -> list:
    return [
        (F.col("p_size") * 1000).cast("bigint").cast("double").alias("x"),
        F.round((F.col("p_retailprice") - 900) * 500).cast("bigint").cast("double").alias("y"),
    ]


def part_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PT: (point_id BIGINT, x DOUBLE, y DOUBLE) for every part row, ids by (x, y, p_partkey)."""
    pts = table(spark, sf_dir, "part").select("p_partkey", *_part_xy())
    return with_sequential_id(pts, ["x", "y", "p_partkey"]).select("point_id", "x", "y")


def distinct_part_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PTD: (point_id BIGINT, x DOUBLE, y DOUBLE), distinct points, ids by (x, y)."""
    pts = table(spark, sf_dir, "part").select(*_part_xy()).distinct()
    return with_sequential_id(pts, ["x", "y"]).select("point_id", "x", "y")


def brand_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BP: (p_partkey, p_brand, x, y) for every part row."""
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", *_part_xy())


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LT: (x DOUBLE, y DOUBLE) for every lineitem row."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") * 1000).cast("bigint").cast("double").alias("x"),
        F.floor("l_extendedprice").cast("bigint").cast("double").alias("y"),
    )


def lineitem_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LTW: (point_id, x, y, w) - distinct LT points with their multiplicity."""
    pts = lineitem_points(spark, sf_dir).groupBy("x", "y").agg(F.count("*").alias("w"))
    return with_sequential_id(pts, ["x", "y"]).select("point_id", "x", "y", "w")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


__all__ = [
    "table", "part_points", "distinct_part_points", "brand_points", "lineitem_points", "lineitem_weighted",
    "events", "materialize",
]
