"""Run records and benchmark-result tables.

* run log: one row per run - (dataset, algorithm, scenario, managers,
  workers, cores, seconds) (S11).  An append is known by a run id and takes effect once: its records are written to a folder of
  their own beside the log and move into it by one rename, which fails if that id is there already.  So a retried
  append leaves one record, writers at the same time lose none, and readers see whole appends only.
* results table: the wide, ``;``-separated file with ``-`` for a missing
  value (S5), one row per configuration and mean/std per algorithm.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

# The results file's header, in file order.
RESULTS_HEADER = [
    "Dataset", "Nodi Gestore", "Nodi Worker", "Core", "Scenario",
    "KMeans - Mean", "KMeans - Std", "KCenter - Mean", "KCenter - Std",
]

RESULTS_SCHEMA = T.StructType([
    T.StructField("Dataset", T.StringType()),
    T.StructField("Nodi Gestore", T.IntegerType()),
    T.StructField("Nodi Worker", T.IntegerType()),
    T.StructField("Core", T.IntegerType()),
    T.StructField("Scenario", T.StringType()),
    T.StructField("KMeans - Mean", T.DoubleType()),
    T.StructField("KMeans - Std", T.DoubleType()),
    T.StructField("KCenter - Mean", T.DoubleType()),
    T.StructField("KCenter - Std", T.DoubleType()),
])

RUN_RECORD_SCHEMA = T.StructType([
    T.StructField("minK", T.IntegerType()),
    T.StructField("maxK", T.IntegerType()),
    T.StructField("bestK", T.IntegerType()),
    T.StructField("time", T.DoubleType()),
])


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The ``;`` results file, ``-`` read as null, explicit schema."""
    return (spark.read.option("header", True).option("sep", ";").option("nullValue", "-")
            .schema(RESULTS_SCHEMA).csv(path))


def write_results(df: DataFrame, path: str) -> None:
    """Write a results table in the same format (header, ``;``, ``-``)."""
    (df.select(*RESULTS_HEADER).write.mode("overwrite").option("header", True)
     .option("sep", ";").option("nullValue", "-").csv(path))


def append_runs(runs: DataFrame, path: str, run_id: str | None = None) -> bool:
    """Add ``minK,maxK,bestK,time`` records (no header) to a run log; false if ``run_id`` was added before.

    Without a run id every call is an append of its own.
    """
    spark = runs.sparkSession
    run_id = run_id or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run_id):
        raise ValueError(f"not a run id: {run_id!r}")
    sc = spark.sparkContext
    as_path = sc._jvm.org.apache.hadoop.fs.Path
    staged, final = as_path(f"{path}/_staged/{uuid.uuid4().hex}/run-{run_id}"), as_path(f"{path}/run-{run_id}")
    fs = final.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(final):
        return False
    runs.select(*[f.name for f in RUN_RECORD_SCHEMA.fields]).write.option("header", False).csv(staged.toString())
    # Moved into the log under its name: a folder of that name that came meanwhile takes it in as a subfolder or refuses it.
    moved = fs.rename(staged, final)
    inside = as_path(final, staged.getName())
    if moved and fs.exists(inside):
        fs.delete(inside, True)
        moved = False
    fs.delete(staged.getParent(), True)
    return bool(moved)


def append_run(spark: SparkSession, path: str, min_k: int, max_k: int, best_k: int,
               seconds: float, run_id: str | None = None) -> bool:
    """S11 for one run."""
    return append_runs(spark.createDataFrame([(min_k, max_k, best_k, float(seconds))], RUN_RECORD_SCHEMA), path, run_id)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The records of all appends; those that are still being written don't count."""
    return spark.read.schema(RUN_RECORD_SCHEMA).csv(f"{path}/run-*")
