"""Session-level helpers: the shared work folder and lineage cuts.

On a cluster the shared folder is the one named by ``spark.checkpoint.dir``
(or set on the SparkContext).  Only when neither is set -- local tests -- do we
pick a folder ourselves.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if none is named."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        # Unset: only allowed for a single-process test session ("local" or
        # "local[...]", not "local-cluster").  A machine-local folder is
        # useless on a cluster (other executors cannot read it).
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="locus-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared work folder."""
    base = work_dir(spark)
    return f"{base.rstrip('/')}/locus/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts lineage (iterative jobs stay small; a lost executor re-reads the
    table instead of recomputing rounds) and fixes non-deterministic columns
    such as ``monotonically_increasing_id`` so later jobs see one value.
    The known schema is passed to the reader, so no job infers it.
    ``path`` names the folder (overwritten) for callers that later ``discard``
    it; by default it is a fresh one.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete finished stages (folders that ``scratch_path`` named).

    Only for tables that no returned DataFrame reads any more.
    """
    sc = spark.sparkContext
    for path in paths:
        if "/locus/" not in path:
            raise ValueError(f"not a scratch path: {path}")
        hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)


def sweep(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished stages now.

    It does so once the driver has collected the plans that made them, which a driver
    with little to do may put off for half an hour; a chain of written stages would
    hold the shuffles of all of them on disk until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

