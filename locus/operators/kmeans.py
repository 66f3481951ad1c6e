"""K-Means: initial centres (C1, C2), assignment (P10, A3), update (A1, A2),
convergence (C3), Lloyd loop (C4) and the k sweep (C6).

Plan of a fit: every task puts its points into summary trees once
(``functions.celltree``; no shuffle), and the trees are cached.  A round is one job: every
task goes down its trees with the centres of every active k, adds whole cells to
the one centre that can own them and tests points on boundaries only, and emits exact
partial sums per (k, center_id); a final hash aggregate combines them, so a few rows for each of
sum(k) centres cross the shuffle from a task and come back to the driver.
A k that has converged drops out of the next round.  The plan does not grow across iterations: the centres
are a few numbers in the task closure, not a chain of joins.

Semantics (see SURVEY 2.5): ties go to the lowest ``center_id``; a centre
that attracts no point disappears (k shrinks) and the fit then counts as not
converged for that iteration; convergence pairs old and new centres by id and
needs every move <= ``tol``; the loop stops at ``max_iter``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from math import sqrt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from locus.functions.celltree import build
from locus.functions.centers import exact_centers, label_all, merged_sums, tree_update_sums, update_sums
from locus.functions.distance import Center, nearest
from locus.functions.sampling import seeded_rank
from locus.runtime import discard, materialize, scratch_path
from locus.sources.points import cache_points

DEFAULT_MAX_ITER = 100
DEFAULT_TOL = 1e-6


@dataclass
class KMeansFit:
    k: int
    centers: list[Center]
    iterations: int = 0
    converged: bool = False
    history: list[list[Center]] = field(default_factory=list)

    @property
    def surviving(self) -> int:
        return len(self.centers)


# ---------------------------------------------------------------- init

def _rows_to_centers(rows, x: str, y: str) -> list[Center]:
    return [(i + 1, float(r[x]), float(r[y])) for i, r in enumerate(rows)]


def init_random(points: DataFrame, k: int, seed: int, key: Sequence[str] = ("point_id",),
                x: str = "x", y: str = "y") -> list[Center]:
    """k distinct rows, seeded: the k smallest ``seeded_rank(key, seed)``.

    Stable under repartitioning (a function of the row's key, not of its
    position); ties fall back to the key.  Prefixes nest: the first k of the
    order for kMax are the draw for k.  A distributed top-k: k rows per task.
    """
    rows = sample_frame(points, k, seed, key[0], x, y).collect()
    return _rows_to_centers(rows, x, y)


def sample_frame(points: DataFrame, k: int, seed: int, id_col: str = "point_id",
                 x: str = "x", y: str = "y") -> DataFrame:
    """The seeded draw as a DataFrame (id_col, x, y), in draw order."""
    return (points.select(id_col, x, y).withColumn("_h", seeded_rank(F.col(id_col), seed))
            .orderBy("_h", id_col).limit(k).drop("_h"))


def spread_ids(n: int, k: int) -> list[int]:
    """Ids 1 + floor(i * n / k), i = 0..k-1: k ids spread over 1..n."""
    return [1 + (i * n) // k for i in range(min(k, n))]


def init_spread(points: DataFrame, k: int, n: int | None = None, id_col: str = "point_id",
                x: str = "x", y: str = "y") -> list[Center]:
    """Points whose id is spread evenly over 1..n (deterministic, SQL-checkable)."""
    n = points.count() if n is None else n
    ids = spread_ids(n, k)
    rows = {r[id_col]: r for r in
            points.filter(F.col(id_col).isin(ids)).select(id_col, x, y).collect()}
    return _rows_to_centers([rows[i] for i in ids if i in rows], x, y)


def sweep_inits(points: DataFrame, ks: Iterable[int], mode: str = "spread", seed: int = 42,
                id_col: str = "point_id", x: str = "x", y: str = "y") -> dict[int, list[Center]]:
    """Initial centres for every k; ``mode`` is spread, or random: one draw for max(k), whose prefixes serve every k."""
    ks = list(ks)
    if mode == "spread":
        n = points.count()
        want = {k: spread_ids(n, k) for k in ks}
        ids = sorted({i for v in want.values() for i in v})
        rows = {r[id_col]: r for r in
                points.filter(F.col(id_col).isin(ids)).select(id_col, x, y).collect()}
        return {k: _rows_to_centers([rows[i] for i in v if i in rows], x, y)
                for k, v in want.items()}
    if mode != "random":
        raise ValueError(f"unknown init mode {mode!r}")
    top = init_random(points, max(ks), seed, (id_col,), x, y)
    return {k: top[:k] for k in ks}


# ----------------------------------------------------------- assign

def assign(points: DataFrame, centers: Sequence[Center], x: str = "x", y: str = "y") -> DataFrame:
    """Add ``center_id`` and ``d2`` (squared distance) of the nearest centre."""
    near = nearest(F.col(x), F.col(y), centers)
    return (points.withColumn("_near", near)
            .withColumn("center_id", F.col("_near.center_id"))
            .withColumn("d2", F.col("_near.d2"))
            .drop("_near"))


def assign_all_k(points: DataFrame, centers_by_k: Mapping[int, Sequence[Center]],
                 x: str = "x", y: str = "y") -> DataFrame:
    """One row per (k, point) with its centre ``cx, cy``; one scan for all k."""
    return label_all(points, centers_by_k, x, y)


# ------------------------------------------------------------ update (A1, A2)

def update_centers(points: DataFrame, centers_by_k: Mapping[int, Sequence[Center]],
                   x: str = "x", y: str = "y", weight: str | None = None) -> DataFrame:
    """A1 + A2: new centre = weighted mean of its members, the exact one rounded once; empty centres vanish.

    Each task sums its points per (k, center_id) before the shuffle, so a few
    rows per centre and task are exchanged, however skewed the clusters are.
    """
    return update_sums(points, centers_by_k, x, y, weight).select("k", "center_id", "cx", "cy", F.col("sw").alias("weight"))


# ------------------------------------------------------------ convergence

def moved(old: Center, new: Center) -> float:
    dx = old[1] - new[1]
    dy = old[2] - new[2]
    return sqrt(dx * dx + dy * dy)


def converged(old: Sequence[Center], new: Sequence[Center], tol: float = DEFAULT_TOL) -> bool:
    """Every old centre survives and moved at most ``tol`` (paired by id)."""
    by_id = {c[0]: c for c in new}
    if len(by_id) != len(old):
        return False
    return all(c[0] in by_id and moved(c, by_id[c[0]]) <= tol for c in old)


# ------------------------------------------------------------- loop

class CellRounds:
    """The cached trees of a point set, and Lloyd rounds over them; one job a round.

    Up to ``TASKS_PER_SUM`` tasks hand their sums to the driver as they are (a few rows for each of sum(k) centres from each).
    The sums of more tasks are added up in Spark first, by one task for each ``TASKS_PER_SUM``.  That is one small shuffle;
    adaptive execution would run it as two jobs, one to measure a few KB, so rounds are planned by a session of
    their own without it, and the caller's session is left as it is.  The trees are a written table, so a lost executor reads its part again.
    """

    TASKS_PER_SUM = 64

    def __init__(self, points: DataFrame, x: str, y: str, weight: str | None):
        spark = points.sparkSession
        # A point set in fewer partitions than there are cores is dealt out once.
        if points.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
            points = points.repartition(spark.sparkContext.defaultParallelism)
        self.path = scratch_path(spark, "cell-trees")
        schema = materialize(build(points, x, y, weight), path=self.path).schema
        self.session = spark.newSession()
        self.session.conf.set("spark.sql.adaptive.enabled", "false")
        self.trees = cache_points(self.session.read.schema(schema).parquet(self.path))
        self.tasks = self.trees.rdd.getNumPartitions()
        self.session.conf.set("spark.sql.shuffle.partitions", str(-(-self.tasks // self.TASKS_PER_SUM)))
        #: Distance tests (of boxes and of points) made so far.
        self.tests = 0

    def update(self, centers: Mapping[int, Sequence[Center]]) -> dict[int, list[Center]]:
        """One Lloyd update for every k: new centres by id (empty ones absent); a few rows for each of sum(k) centres come back."""
        sums = tree_update_sums(self.trees, centers)
        got = (sums if self.tasks <= self.TASKS_PER_SUM else merged_sums(sums)).toArrow()
        rows = list(zip(*(got[c].to_pylist() for c in ("k", "center_id", "dim", "bin", "whole"))))
        self.tests += sum(int(r[4]) for r in rows if r[0] < 0)
        new: dict[int, list[Center]] = {}
        for (k, cid), (_, _, _, cx, cy) in exact_centers(r for r in rows if r[0] >= 0).items():
            new.setdefault(k, []).append((cid, cx, cy))
        return new

    def close(self) -> None:
        self.trees.unpersist()
        discard(self.session, self.path)


def kmeans_sweep(points: DataFrame, inits: Mapping[int, Sequence[Center]],
                 max_iter: int = DEFAULT_MAX_ITER, tol: float = DEFAULT_TOL,
                 x: str = "x", y: str = "y", weight: str | None = None,
                 keep_history: bool = False, stats: dict | None = None) -> dict[int, KMeansFit]:
    """Run Lloyd's loop for every k at once; one job per iteration.

    ``points`` is scanned once, into trees.  Returns, per k, the centres after the last update.  ``stats`` takes
    the rounds and the distance tests made.
    """
    fits = {int(k): KMeansFit(int(k), [tuple(c) for c in cs]) for k, cs in inits.items()}
    active = {k for k, f in fits.items() if f.centers and max_iter > 0}
    if not active:
        return fits
    rounds = CellRounds(points, x, y, weight)
    n_rounds = 0
    try:
        while active:
            new = rounds.update({k: fits[k].centers for k in active})
            n_rounds += 1
            for k in list(active):
                fit = fits[k]
                nxt = sorted(new.get(k, []))
                fit.converged = converged(fit.centers, nxt, tol)
                if keep_history:
                    fit.history.append(fit.centers)
                fit.centers = nxt
                fit.iterations += 1
                if fit.converged or fit.iterations >= max_iter or not nxt:
                    active.discard(k)
    finally:
        rounds.close()
    if stats is not None:
        stats.update(rounds=n_rounds, tests=rounds.tests)
    return fits


def kmeans(points: DataFrame, init: Sequence[Center], max_iter: int = DEFAULT_MAX_ITER,
           tol: float = DEFAULT_TOL, x: str = "x", y: str = "y",
           weight: str | None = None) -> KMeansFit:
    """C4 for a single k."""
    k = len(init)
    return kmeans_sweep(points, {k: init}, max_iter, tol, x, y, weight)[k]


# -------------------------------------------------------------- result tables

CENTERS_SCHEMA = T.StructType([
    T.StructField("k", T.IntegerType(), False),
    T.StructField("center_id", T.IntegerType(), False),
    T.StructField("cx", T.DoubleType(), False),
    T.StructField("cy", T.DoubleType(), False),
])


def centers_frame(spark: SparkSession, centers_by_k: Mapping[int, Sequence[Center]]) -> DataFrame:
    """One table of centres keyed by k (at most sum(k) rows)."""
    rows = [(int(k), int(c), float(cx), float(cy))
            for k, cs in sorted(centers_by_k.items()) for c, cx, cy in cs]
    return spark.createDataFrame(rows, CENTERS_SCHEMA)


def fits_frame(spark: SparkSession, fits: Mapping[int, KMeansFit]) -> DataFrame:
    rows = [(k, f.iterations, f.converged, f.surviving) for k, f in sorted(fits.items())]
    return spark.createDataFrame(
        rows, "k INT, iterations INT, converged BOOLEAN, surviving INT")
