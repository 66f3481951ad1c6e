"""Analysis of benchmark runs.

Inputs are run logs (one row per run) or results tables (one row per
configuration); every step is an aggregate or a window over the
*aggregated* table, whose size is the number of configurations, not of runs.

Mean and population standard deviation are taken of the values as they are.
On request (``scale``, e.g. 100 for hundredths of a second) values are first rounded to fixed
point: sums of integers are exact in any order, so the mean is one division and
the deviation one square root - the same bits on every engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from locus.operators.joins import join_small

# Scenario labels and algorithm names of the results file.
SEQUENTIAL = "Sequenziale"
PARALLEL = "Parallelo"
DISTRIBUTED = "Distribuito"
ALGORITHMS = ("KMeans", "KCenter")

Z_95 = 1.96


def mean_std(runs: DataFrame, group: Sequence[str], value: str = "seconds",
             scale: int | None = None) -> DataFrame:
    """Per group ``n``, ``mean`` and population ``std`` of ``value``."""
    if scale is None:
        return runs.groupBy(*group).agg(F.count("*").alias("n"), F.avg(value).alias("mean"),
                                        F.stddev_pop(value).alias("std"))
    c = F.round(F.col(value) * scale).cast("decimal(38,0)")
    agg = runs.groupBy(*group).agg(F.count("*").alias("n"), F.sum(c).alias("s1"),
                                   F.sum(c * c).alias("s2"))
    n = F.col("n").cast("decimal(38,0)")
    var_num = n * F.col("s2") - F.col("s1") * F.col("s1")
    return agg.select(
        *group, "n",
        (F.col("s1").cast("double") / F.col("n") / F.lit(float(scale))).alias("mean"),
        (F.sqrt(var_num.cast("double")) / F.col("n") / F.lit(float(scale))).alias("std"))


def results_wide(stats: DataFrame) -> DataFrame:
    """Pivot per-algorithm mean/std into the results-file layout (one row per
    configuration).  The algorithm list is fixed, so no distinct pass."""
    keys = ["dataset", "managers", "workers", "cores", "scenario"]
    piv = (stats.groupBy(*keys).pivot("algorithm", list(ALGORITHMS))
           .agg(F.first("mean").alias("mean"), F.first("std").alias("std")))
    return piv.select(
        F.col("dataset").alias("Dataset"), F.col("managers").alias("Nodi Gestore"),
        F.col("workers").alias("Nodi Worker"), F.col("cores").alias("Core"),
        F.col("scenario").alias("Scenario"),
        *[F.col(f"{a}_{m}").alias(f"{a} - {m.capitalize()}")
          for a in ALGORITHMS for m in ("mean", "std")])


def clean_results(df: DataFrame) -> DataFrame:
    """Core = 1 for sequential rows, counts as int, snake-case names."""
    return df.select(
        F.col("Dataset").alias("dataset"),
        F.col("Nodi Gestore").cast("int").alias("managers"),
        F.col("Nodi Worker").cast("int").alias("workers"),
        F.when(F.col("Scenario") == SEQUENTIAL, F.lit(1)).otherwise(F.col("Core"))
        .cast("int").alias("cores"),
        F.col("Scenario").alias("scenario"),
        *[F.col(f"{a} - {m}").cast("double").alias(f"{a.lower()}_{m.lower()}")
          for a in ALGORITHMS for m in ("Mean", "Std")])


def split_algorithm(clean: DataFrame, algorithm: str, round_to: int | None = None) -> DataFrame:
    """R6 for one algorithm: drop the other's columns (P2), rename (P3),
    keep rows that have a time (P6; e.g. a dataset run only with K-Center),
    optionally round half-to-even like pandas (P4)."""
    a = algorithm.lower()
    mean, std = F.col(f"{a}_mean"), F.col(f"{a}_std")
    if round_to is not None:
        mean, std = F.bround(mean, round_to), F.bround(std, round_to)
    return (clean.filter(F.col(f"{a}_mean").isNotNull())
            .select("dataset", F.lit(algorithm).alias("algorithm"), "scenario", "managers",
                    "workers", "cores", mean.alias("mean"), std.alias("std")))


def results_long(clean: DataFrame, round_to: int | None = None) -> DataFrame:
    """Both algorithms in long form."""
    out = None
    for a in ALGORITHMS:
        part = split_algorithm(clean, a, round_to)
        out = part if out is None else out.unionByName(part)
    return out


def speedup_vs_baseline(long: DataFrame) -> DataFrame:
    """Sequential mean of the same dataset and algorithm / mean, for the
    non-distributed rows.  Of several sequential rows the one with the fewest managers, workers and cores counts, then the least mean."""
    least = F.struct(*[F.coalesce(c, F.lit(-1)) for c in ("managers", "workers", "cores")], "mean")
    base = (long.filter(F.col("scenario") == SEQUENTIAL)
            .groupBy("algorithm", "dataset").agg(F.min_by("mean", least).alias("seq_mean")))
    rows = long.filter(F.col("scenario") != DISTRIBUTED)
    return (join_small(rows, base, ["algorithm", "dataset"])
            .withColumn("speedup", F.col("seq_mean") / F.col("mean"))
            .select("algorithm", "dataset", "scenario", "cores", "mean", "speedup"))


def speedup_vs_smallest(long: DataFrame) -> DataFrame:
    """R2: among distributed rows, the mean of the one with fewest workers /
    mean.  The window runs over the aggregated table (one row per config)."""
    w = Window.partitionBy("algorithm", "dataset").orderBy("workers", "cores")
    rows = long.filter(F.col("scenario") == DISTRIBUTED)
    return (rows.withColumn("base_mean", F.first("mean").over(w))
            .select("algorithm", "dataset", "workers", "mean",
                    (F.col("base_mean") / F.col("mean")).alias("speedup")))


def speedup_max(speedups: DataFrame) -> DataFrame:
    """Per algorithm, the largest speedup and the extreme means."""
    return speedups.groupBy("algorithm").agg(
        F.max("speedup").alias("max_speedup"), F.max("mean").alias("max_mean"),
        F.min("mean").alias("min_mean"))


def confidence_band(long: DataFrame, z: float = Z_95, n: Column | None = None) -> DataFrame:
    """Mean +/- z * std / sqrt(n); by default n is the number of
    configurations plotted together (dataset, algorithm, scenario), as in the
    reference; pass ``n`` (e.g. the run count) to use another."""
    w = Window.partitionBy("algorithm", "dataset", "scenario")
    n_col = n if n is not None else F.count(F.lit(1)).over(w)
    half = F.lit(z) * F.col("std") / F.sqrt(n_col.cast("double"))
    rows = long.filter(F.col("scenario") != SEQUENTIAL)
    return (rows.withColumn("half", half)
            .select("algorithm", "dataset", "scenario", "workers", "cores", "mean", "half",
                    (F.col("mean") - F.col("half")).alias("lo"),
                    (F.col("mean") + F.col("half")).alias("hi")))


def distinct_sorted(long: DataFrame, col: str, group: Sequence[str]) -> DataFrame:
    """The distinct values of ``col`` per group, with their sorted position."""
    d = long.select(*group, col).distinct()
    w = Window.partitionBy(*group).orderBy(col)
    return d.withColumn("pos", F.row_number().over(w).cast("int"))
