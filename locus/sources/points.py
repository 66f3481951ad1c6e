"""Point scans and sinks.

Scans use an explicit schema (no inference pass over the file), keep only the
columns asked for (the parquet reader prunes the rest), cast coordinates to
double and drop rows with a null, NaN or infinite coordinate.  Sinks are
distributed writes; partitioned sinks use ``partitionBy`` so one file set per
k (or per province) is written by the executors, never by the driver.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from locus.operators.joins import join_small

PREPARED_SCHEMA = T.StructType(
    [
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
    ]
)

RAW_PLACES_SCHEMA = T.StructType(
    [
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("ita_general_2020", T.DoubleType()),
    ]
)

ASSIGNMENT_SCHEMA = T.StructType(
    [
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("cx", T.DoubleType()),
        T.StructField("cy", T.DoubleType()),
    ]
)


def finite(c: Column) -> Column:
    """Not null, not NaN, not +/- infinity."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def valid_points(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Cast the coordinates to double and keep rows where both are finite."""
    out = df.withColumn(x, F.col(x).cast("double")).withColumn(y, F.col(y).cast("double"))
    return out.filter(finite(F.col(x)) & finite(F.col(y)))


def read_points(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    x: str = "x",
    y: str = "y",
    extra: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """S1/S3 + P1: read points and keep ``x``, ``y`` (plus ``extra``) as doubles."""
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).schema(schema or PREPARED_SCHEMA)
    elif schema is not None:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    cols = [x, y, *(extra or [])]
    return valid_points(df.select(*cols), x, y)


def read_raw_places(spark: SparkSession, path: str) -> DataFrame:
    """S3: raw places (longitude, latitude, population) with a fixed schema."""
    df = spark.read.option("header", True).schema(RAW_PLACES_SCHEMA).csv(path)
    return valid_points(df, "longitude", "latitude")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (a peek; the limit is the feature)."""
    return df.limit(n)


def cache_points(df: DataFrame) -> DataFrame:
    """Columnar cache that spills to disk rather than failing."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


#: Rows of a file of a folder.
FILE_ROWS = 1_000_000


def clustered(df: DataFrame, groups: list[str], file_rows: int = FILE_ROWS) -> DataFrame:
    """``df`` dealt so that every group is written by ceil(its rows / file_rows) tasks at most, however many tasks there are.

    The rows of a group are counted first; a group larger than a file is dealt over as many salts, by a hash of the whole row and its
    task, so neither a group that holds a third of the rows nor copies of one row make a hot task.
    """
    keys = [F.col(f"`{c}`") for c in groups]
    counts = df.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(file_rows)).alias("_files")).select(
        *[k.alias(f"_g{i}") for i, k in enumerate(keys)], "_files")
    on = reduce(and_, [k.eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)])
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())
    dealt = join_small(df, counts, on, "left").withColumn("_salt", F.pmod(hashed, F.col("_files")))
    return dealt.repartition(*[F.col(f"_g{i}") for i in range(len(groups))], "_salt").select(*[F.col(f"`{c}`") for c in df.columns])


def write_points(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 fmt: str = "csv", file_rows: int = FILE_ROWS) -> None:
    """Header CSV (or parquet), optionally one folder per group with as few files as its rows need."""
    w = (clustered(df, partition_by, file_rows) if partition_by else df).write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


def write_assignments(assignments: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """One folder per k of ``x,y,cx,cy`` lines without a header."""
    (clustered(assignments.select("k", "x", "y", "cx", "cy"), ["k"], file_rows)
     .write.mode("overwrite").partitionBy("k").option("header", False).csv(path))


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """Read S9 back; ``k`` comes from the folder names (partition discovery)."""
    schema = T.StructType([*ASSIGNMENT_SCHEMA.fields, T.StructField("k", T.IntegerType())])
    return spark.read.option("header", False).schema(schema).csv(path)


def write_wcss(curve: DataFrame, path: str) -> None:
    """``k,wcss`` lines; a handful of rows, so one file."""
    curve.select("k", "wcss").coalesce(1).write.mode("overwrite").csv(path)


def read_wcss(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("k INT, wcss DOUBLE").csv(path)
