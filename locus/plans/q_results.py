"""Queries for run logs and result analysis, on a run log derived from ``events``.

EV (FIXTURES.md): every event is one benchmark run of ``value`` seconds.
Its configuration is read from the row by fixed rules:

* dataset   = event_type
* algorithm = KMeans before noon (hour of ts < 12), else KCenter
* k = props.k (0..99): k < 10 sequential (2 cores, 0 workers);
  10 <= k < 60 parallel, cores 2^((k-10) div 10) = 1..16, 0 workers;
  k >= 60 distributed, 4 cores, workers 2^(1 + (k-60) div 10) = 2..16
* managers  = 1
"""

from __future__ import annotations

from pyspark.sql import functions as F

from locus.operators import results as R
from locus.plans import fixtures as fx
from locus.runtime import scratch_path
from locus.sources import runlog

GROUP = ["dataset", "algorithm", "scenario", "managers", "workers", "cores"]


def run_log(spark, sf_dir):
    ev = fx.events(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("int")
    scenario = (F.when(k < 10, F.lit(R.SEQUENTIAL)).when(k < 60, F.lit(R.PARALLEL))
                .otherwise(F.lit(R.DISTRIBUTED)))
    workers = F.when(k >= 60, F.pow(F.lit(2), F.floor((k - 60) / 10) + 1)).otherwise(F.lit(0))
    cores = (F.when(k < 10, F.lit(2))
             .when(k < 60, F.pow(F.lit(2), F.floor((k - 10) / 10)))
             .otherwise(F.lit(4)))
    return ev.select(
        F.col("event_type").alias("dataset"),
        F.when(F.hour("ts") < 12, F.lit("KMeans")).otherwise(F.lit("KCenter")).alias("algorithm"),
        scenario.alias("scenario"), F.lit(1).alias("managers"),
        workers.cast("int").alias("workers"), cores.cast("int").alias("cores"),
        F.col("value").alias("seconds"))


def _stats(spark, sf_dir):
    """In hundredths of a second, as the results file has them: exact in any order."""
    return R.mean_std(run_log(spark, sf_dir), GROUP, scale=100)


def _clean(spark, sf_dir):
    """Results table written as the ``;`` file and read back (S5), then cleaned."""
    path = scratch_path(spark, "results")
    runlog.write_results(R.results_wide(_stats(spark, sf_dir)), path)
    return R.clean_results(runlog.read_results(spark, path))


def runlog_mean_std(spark, sf_dir):
    """A8 on run times in minutes as they are; shown to 9 places."""
    runs = run_log(spark, sf_dir).withColumn("minutes", F.col("seconds") / 60)
    return R.mean_std(runs, GROUP, "minutes").select(
        *GROUP, "n", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


def results_rounded(spark, sf_dir):
    """The long table with times to 2 places, from times that have more."""
    third = run_log(spark, sf_dir).withColumn("seconds", F.col("seconds") / 3)
    path = scratch_path(spark, "results")
    runlog.write_results(R.results_wide(R.mean_std(third, GROUP)), path)
    return R.results_long(R.clean_results(runlog.read_results(spark, path)), round_to=2)


def run_records_mean(spark, sf_dir):
    """S11 into A8: run records appended in two batches, read back and averaged per best k."""
    ev = fx.events(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("int")
    runs = ev.select(F.lit(5).alias("minK"), F.lit(20).alias("maxK"), (F.lit(5) + k % 16).alias("bestK"),
                     F.col("value").alias("time"), k.alias("k"))
    path = scratch_path(spark, "runs")
    for batch in (runs.filter("k < 50"), runs.filter("k >= 50")):
        runlog.append_runs(batch, path)
    return R.mean_std(runlog.read_runs(spark, path), ["bestK"], "time").select(
        F.col("bestK").alias("best_k"), "n", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


def results_clean(spark, sf_dir):
    return _clean(spark, sf_dir)


def results_long(spark, sf_dir):
    return R.results_long(_clean(spark, sf_dir))


def distinct_sorted(spark, sf_dir):
    long = R.results_long(_clean(spark, sf_dir)).filter(F.col("scenario") == R.PARALLEL)
    return R.distinct_sorted(long, "cores", ["algorithm", "dataset"])


def speedup_vs_baseline(spark, sf_dir):
    return R.speedup_vs_baseline(R.results_long(_clean(spark, sf_dir)))


def speedup_vs_smallest(spark, sf_dir):
    return R.speedup_vs_smallest(R.results_long(_clean(spark, sf_dir)))


def speedup_max(spark, sf_dir):
    return R.speedup_max(R.speedup_vs_baseline(R.results_long(_clean(spark, sf_dir))))


def ci_half_width(spark, sf_dir):
    return R.confidence_band(R.results_long(_clean(spark, sf_dir)))


QUERIES = {
    "runlog_mean_std": runlog_mean_std,
    "results_rounded": results_rounded,
    "run_records_mean": run_records_mean,
    "results_clean": results_clean,
    "results_long": results_long,
    "distinct_sorted": distinct_sorted,
    "speedup_vs_baseline": speedup_vs_baseline,
    "speedup_vs_smallest": speedup_vs_smallest,
    "speedup_max": speedup_max,
    "ci_half_width": ci_half_width,
}

_RL = """WITH ev AS (
  SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
rl AS (
  SELECT event_type AS dataset,
         CASE WHEN hour(ts) < 12 THEN 'KMeans' ELSE 'KCenter' END AS algorithm,
         CASE WHEN k < 10 THEN 'Sequenziale' WHEN k < 60 THEN 'Parallelo' ELSE 'Distribuito' END
           AS scenario,
         1 AS managers,
         CAST(CASE WHEN k >= 60 THEN 1 << (1 + (k - 60) // 10) ELSE 0 END AS INTEGER) AS workers,
         CAST(CASE WHEN k < 10 THEN 2 WHEN k < 60 THEN 1 << ((k - 10) // 10) ELSE 4 END AS INTEGER)
           AS cores,
         value AS seconds
  FROM ev),
st AS (
  SELECT dataset, algorithm, scenario, managers, workers, cores, count(*) AS n,
         CAST(sum(CAST(round(seconds * 100) AS HUGEINT)) AS DOUBLE) / count(*) / 100.0 AS mean,
         sqrt(CAST(count(*) * sum(CAST(round(seconds * 100) AS HUGEINT) * CAST(round(seconds * 100) AS HUGEINT))
                   - sum(CAST(round(seconds * 100) AS HUGEINT)) * sum(CAST(round(seconds * 100) AS HUGEINT))
                   AS DOUBLE)) / count(*) / 100.0 AS std
  FROM rl GROUP BY ALL),
wide AS (
  SELECT dataset, managers, workers, cores, scenario,
         max(mean) FILTER (WHERE algorithm = 'KMeans') AS km_mean,
         max(std) FILTER (WHERE algorithm = 'KMeans') AS km_std,
         max(mean) FILTER (WHERE algorithm = 'KCenter') AS kc_mean,
         max(std) FILTER (WHERE algorithm = 'KCenter') AS kc_std
  FROM st GROUP BY ALL),
clean AS (
  SELECT dataset, CAST(managers AS INTEGER) AS managers, CAST(workers AS INTEGER) AS workers,
         CAST(CASE WHEN scenario = 'Sequenziale' THEN 1 ELSE cores END AS INTEGER) AS cores,
         scenario, km_mean AS kmeans_mean, km_std AS kmeans_std,
         kc_mean AS kcenter_mean, kc_std AS kcenter_std
  FROM wide),
lng AS (
  SELECT dataset, 'KMeans' AS algorithm, scenario, managers, workers, cores,
         kmeans_mean AS mean, kmeans_std AS std FROM clean WHERE kmeans_mean IS NOT NULL
  UNION ALL
  SELECT dataset, 'KCenter', scenario, managers, workers, cores, kcenter_mean, kcenter_std
  FROM clean WHERE kcenter_mean IS NOT NULL),
sp AS (
  SELECT l.algorithm, l.dataset, l.scenario, l.cores, l.mean, b.seq_mean / l.mean AS speedup
  FROM lng l JOIN (SELECT algorithm, dataset, first(mean) AS seq_mean FROM lng
                   WHERE scenario = 'Sequenziale' GROUP BY ALL) b USING (algorithm, dataset)
  WHERE l.scenario <> 'Distribuito')
"""

ORACLE = {
    "runlog_mean_std": _RL + """
SELECT dataset, algorithm, scenario, managers, workers, cores, count(*) AS n,
       round(avg(seconds / 60), 9) AS mean, round(stddev_pop(seconds / 60), 9) AS std
FROM rl GROUP BY ALL""",
    "results_rounded": _RL + """
SELECT dataset, algorithm, scenario, managers, workers,
       CAST(CASE WHEN scenario = 'Sequenziale' THEN 1 ELSE cores END AS INTEGER) AS cores,
       round_even(avg(seconds / 3), 2) AS mean, round_even(stddev_pop(seconds / 3), 2) AS std
FROM rl GROUP BY dataset, algorithm, scenario, managers, workers, cores""",
    "run_records_mean": """
SELECT 5 + CAST(json_extract(props, '$.k') AS INTEGER) % 16 AS best_k, count(*) AS n,
       round(avg(value), 9) AS mean, round(stddev_pop(value), 9) AS std
FROM events GROUP BY 1""",
    "results_clean": _RL + "SELECT * FROM clean",
    "results_long": _RL + "SELECT * FROM lng",
    "distinct_sorted": _RL + """
SELECT algorithm, dataset, cores,
       CAST(row_number() OVER (PARTITION BY algorithm, dataset ORDER BY cores) AS INTEGER) AS pos
FROM (SELECT DISTINCT algorithm, dataset, cores FROM lng WHERE scenario = 'Parallelo') d""",
    "speedup_vs_baseline": _RL + "SELECT * FROM sp",
    "speedup_vs_smallest": _RL + """
SELECT algorithm, dataset, workers, mean,
       first_value(mean) OVER (PARTITION BY algorithm, dataset ORDER BY workers, cores) / mean AS speedup
FROM lng WHERE scenario = 'Distribuito'""",
    "speedup_max": _RL + """
SELECT algorithm, max(speedup) AS max_speedup, max(mean) AS max_mean, min(mean) AS min_mean
FROM sp GROUP BY algorithm""",
    "ci_half_width": _RL + """
SELECT algorithm, dataset, scenario, workers, cores, mean, half, mean - half AS lo, mean + half AS hi
FROM (SELECT *, 1.96 * std / sqrt(CAST(count(*) OVER (PARTITION BY algorithm, dataset, scenario) AS DOUBLE))
             AS half
      FROM lng WHERE scenario <> 'Sequenziale') t""",
}
