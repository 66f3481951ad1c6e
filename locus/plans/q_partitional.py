"""Queries for scans, assignment, K-Means, K-Center and the choice of k.

Spark side: fixtures from ``plans.fixtures`` and operators from
``operators``; oracle side: the same question restated in DuckDB SQL
(``plans.sqlparts``).  Every query reads the whole ``part`` (PT) or
``lineitem`` (LTW) table.

Exactness: coordinates are integers, so coordinate sums are exact and a
centre (sum / count) is one correctly rounded division - the same bits in
any IEEE engine; no rounding is applied to it.  Only the WCSS of fitted
(non-integer) centres depends on summation order; it is rounded to tens
(values near 1e11).  WCSS against integer centres is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from locus.functions import distance as D
from locus.functions.sampling import seeded_rank
from locus.operators import elbow, kcenter as kc, kmeans as km
from locus.plans import fixtures as fx
from locus.plans import sqlparts as S
from locus.runtime import materialize
from locus.sources.points import cache_points, preview

KS = list(range(S.K_MIN, S.K_MAX + 1))
K_FIXED = 5          # single-k queries
FIXED_ITERS = 3      # kmeans_fixed_iters

RANDOM_SEED = 42


def _pt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PT, written once for the query that asks for it."""
    return materialize(fx.part_points(spark, sf_dir), "pt")


def _ltw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(fx.lineitem_weighted(spark, sf_dir), "ltw")


def _sweep(pt: DataFrame, max_iter: int = km.DEFAULT_MAX_ITER, mode: str = "spread"):
    """The fits of every k; the points are held in memory for the rounds only."""
    held = cache_points(pt)
    fits = km.kmeans_sweep(held, km.sweep_inits(held, KS, mode, RANDOM_SEED), max_iter=max_iter)
    held.unpersist()
    return fits


def _traversal(pt: DataFrame, **start):
    held = cache_points(pt)
    steps = kc.kcenter_traversal(held, S.K_MAX, **(start or {"first_id": 1}))
    held.unpersist()
    return steps


# ------------------------------------------------------------------ scans

def points_scan(spark, sf_dir):
    return _pt(spark, sf_dir).select("point_id", "x", "y")


def lineitem_points(spark, sf_dir):
    return _ltw(spark, sf_dir).select("point_id", "x", "y", F.col("w").cast("bigint").alias("w"))


# ------------------------------------------------------ distance, assign

def distance_to_centers(spark, sf_dir):
    """Every point's distance to each of the k=5 spread centres."""
    pt = _pt(spark, sf_dir)
    cs = km.init_spread(pt, K_FIXED)
    # k literal centres expanded per point by a generator: a projection, no join.
    centers = F.array(*[F.struct(F.lit(int(c)).alias("center_id"), F.lit(float(cx)).alias("cx"),
                                 F.lit(float(cy)).alias("cy")) for c, cx, cy in cs])
    return (pt.select("point_id", "x", "y", F.inline(centers))
            .select("point_id", "center_id",
                    D.dist(F.col("x"), F.col("y"), F.col("cx"), F.col("cy")).alias("dist")))


def nearest_center_assign(spark, sf_dir):
    """P10/A3: nearest of the k=5 spread centres (built-in least over structs)."""
    pt = _pt(spark, sf_dir)
    cs = km.init_spread(pt, K_FIXED)
    return km.assign(pt, cs).select("point_id", "center_id", "d2")


def assign_all_k(spark, sf_dir):
    """Label every point for every k with its fitted K-Means centre."""
    pt = _pt(spark, sf_dir)
    fits = _sweep(pt)
    out = km.assign_all_k(pt, {k: f.centers for k, f in fits.items()})
    return out.select("k", "point_id", "center_id", "cx", "cy")


# ------------------------------------------------------------- K-Means (LTW)

def centroid_update(spark, sf_dir):
    """A1/A2: one weighted update step for every k = 5..20 on LTW."""
    ltw = _ltw(spark, sf_dir)
    inits = km.sweep_inits(ltw, KS)
    return (km.update_centers(ltw, inits, weight="w")
            .select("k", "center_id", "cx", "cy",
                    F.col("weight").cast("bigint").alias("weight")))


def convergence_check(spark, sf_dir):
    """After one step, per k: surviving centres, largest move, converged."""
    ltw = _ltw(spark, sf_dir)
    inits = km.sweep_inits(ltw, KS)
    fits = km.kmeans_sweep(ltw, inits, max_iter=1, weight="w")
    rows = []
    for k, f in sorted(fits.items()):
        old = {c[0]: c for c in inits[k]}
        moves = [km.moved(old[c[0]], c) for c in f.centers]
        rows.append((k, f.surviving, max(moves), f.converged))
    return (spark.createDataFrame(rows, "k INT, surviving INT, max_move DOUBLE, converged BOOLEAN")
            .select("k", "surviving", "max_move", "converged"))


# ------------------------------------------------------------- K-Means (PT)

def _centers_rows(fits):
    return {k: f.centers for k, f in fits.items()}


def kmeans_fixed_iters(spark, sf_dir):
    fits = _sweep(_pt(spark, sf_dir), FIXED_ITERS)
    return (km.centers_frame(spark, _centers_rows(fits))
            .select("k", "center_id", "cx", "cy"))


def kmeans_converged(spark, sf_dir):
    return km.fits_frame(spark, _sweep(_pt(spark, sf_dir)))


def kmeans_sweep_centers(spark, sf_dir):
    return (km.centers_frame(spark, _centers_rows(_sweep(_pt(spark, sf_dir))))
            .select("k", "center_id", "cx", "cy"))


def wcss_by_k(spark, sf_dir):
    """A4: WCSS of the spread initial centres, all k in one scan (exact)."""
    pt = _pt(spark, sf_dir)
    return elbow.wcss_curve(pt, km.sweep_inits(pt, KS))


def kmeans_wcss_curve(spark, sf_dir):
    pt = _pt(spark, sf_dir)
    curve = elbow.wcss_curve(pt, _centers_rows(_sweep(pt)))
    return curve.select("k", F.round("wcss", -1).alias("wcss"))


# ------------------------------------------------------------------ K-Center

def farthest_point(spark, sf_dir):
    """A5: the point farthest from point 1."""
    pt = _pt(spark, sf_dir)
    start = kc.first_center(pt, 1)
    far = kc.farthest_point(pt, [(1, start[1], start[2])])
    return spark.createDataFrame([(far.point_id, far.x, far.y, far.d2)],
                                 "point_id BIGINT, x DOUBLE, y DOUBLE, d2 DOUBLE")


def kcenter_traversal(spark, sf_dir):
    return kc.traversal_frame(spark, _traversal(_pt(spark, sf_dir)))


def kcenter_wcss_curve(spark, sf_dir):
    pt = _pt(spark, sf_dir)
    steps = _traversal(pt)
    return elbow.prefix_curve(pt, kc.centers_of(steps), S.K_MIN, S.K_MAX)


def elbow_best_k(spark, sf_dir):
    pt = _pt(spark, sf_dir)
    fits = _sweep(pt)
    kmc = elbow.wcss_curve(pt, _centers_rows(fits)).withColumn("algorithm", F.lit("kmeans"))
    kcc = (elbow.prefix_curve(pt, kc.centers_of(_traversal(pt)), S.K_MIN, S.K_MAX)
           .select("k", "wcss").withColumn("algorithm", F.lit("kcenter")))
    return elbow.best_k(kmc.unionByName(kcc), ["algorithm"]).select("algorithm", "best_k")


def kmeans_random_start(spark, sf_dir):
    """C1 in a fit: every k starts from the seeded draw; the fitted centres."""
    return (km.centers_frame(spark, _centers_rows(_sweep(_pt(spark, sf_dir), mode="random")))
            .select("k", "center_id", "cx", "cy"))


def kcenter_random_start(spark, sf_dir):
    """C2 in a traversal: the first centre is the first of the seeded draw."""
    return kc.traversal_frame(spark, _traversal(_pt(spark, sf_dir), seed=RANDOM_SEED))


def points_preview(spark, sf_dir):
    """The first ten points by id (a top-k report)."""
    return preview(_pt(spark, sf_dir).orderBy("point_id"), 10)


def sample_init(spark, sf_dir):
    """Seeded draw of kMax distinct LTW points; center_id = draw order."""
    draw = km.sample_frame(_ltw(spark, sf_dir), S.K_MAX, RANDOM_SEED)
    # kMax rows after the top-k: numbering them is a window over 20 rows.
    w = Window.orderBy(seeded_rank(F.col("point_id"), RANDOM_SEED), "point_id")
    return draw.select(F.row_number().over(w).cast("int").alias("center_id"), "x", "y")


QUERIES = {
    "points_scan": points_scan,
    "lineitem_points": lineitem_points,
    "distance_to_centers": distance_to_centers,
    "nearest_center_assign": nearest_center_assign,
    "assign_all_k": assign_all_k,
    "centroid_update": centroid_update,
    "convergence_check": convergence_check,
    "kmeans_fixed_iters": kmeans_fixed_iters,
    "kmeans_converged": kmeans_converged,
    "kmeans_sweep_centers": kmeans_sweep_centers,
    "wcss_by_k": wcss_by_k,
    "kmeans_wcss_curve": kmeans_wcss_curve,
    "farthest_point": farthest_point,
    "kcenter_traversal": kcenter_traversal,
    "kcenter_wcss_curve": kcenter_wcss_curve,
    "elbow_best_k": elbow_best_k,
    "sample_init": sample_init,
    "kmeans_random_start": kmeans_random_start,
    "kcenter_random_start": kcenter_random_start,
    "points_preview": points_preview,
}

# ---------------------------------------------------------------- oracle SQL

_W = S.with_recursive
_KM = [S.PT, S.spread_init("pt", S.K_MIN, S.K_MAX), S.kmeans_rec("pt", "init"), S.kmeans_final()]
_KC = [S.PT, S.kcenter_rec("pt", S.K_MAX)]
_NEAR_P = S.nearest("i.cs")

ORACLE = {
    "sample_init": S.with_recursive(S.LTW) + f"""
SELECT CAST(row_number() OVER (ORDER BY h, point_id) AS INTEGER) AS center_id, x, y
FROM (SELECT point_id, x, y, md5(CAST(point_id AS VARCHAR) || ':{RANDOM_SEED}') AS h
      FROM ltw ORDER BY h, point_id LIMIT {S.K_MAX}) d""",
    "kmeans_random_start": _W(S.PT, S.random_init("pt", S.K_MIN, S.K_MAX, RANDOM_SEED),
                              S.kmeans_rec("pt", "init"), S.kmeans_final()) + """
SELECT CAST(k AS INTEGER) AS k, CAST(u.c AS INTEGER) AS center_id,
       u.x AS cx, u.y AS cy
FROM (SELECT k, unnest(cs) AS u FROM kmf)""",
    "kcenter_random_start": _W(S.PT, S.kcenter_rec("pt", S.K_MAX, first_sql=(
        f"(SELECT point_id FROM pt ORDER BY md5(CAST(point_id AS VARCHAR) || ':{RANDOM_SEED}'), point_id LIMIT 1)"))) + """
SELECT CAST(i AS INTEGER) AS center_id, pid AS point_id, x, y, d2 FROM kc""",
    "points_preview": _W(S.PT) + "SELECT point_id, x, y FROM pt ORDER BY point_id LIMIT 10",
    "points_scan": _W(S.PT) + "SELECT point_id, x, y FROM pt",
    "lineitem_points": _W(S.LTW) + "SELECT point_id, x, y, CAST(w AS BIGINT) AS w FROM ltw",
    "distance_to_centers": _W(S.PT, S.spread_init("pt", K_FIXED, K_FIXED)) + """
SELECT p.point_id, CAST(c.u.c AS INTEGER) AS center_id,
       sqrt((p.x - c.u.x) * (p.x - c.u.x) + (p.y - c.u.y) * (p.y - c.u.y)) AS dist
FROM pt p, (SELECT unnest(cs) AS u FROM init) c""",
    "nearest_center_assign": _W(S.PT, S.spread_init("pt", K_FIXED, K_FIXED)) + f"""
SELECT p.point_id, CAST({_NEAR_P}.c AS INTEGER) AS center_id, {_NEAR_P}.d AS d2
FROM pt p, init i""",
    "assign_all_k": _W(*_KM) + f"""
SELECT CAST(i.k AS INTEGER) AS k, p.point_id, CAST({_NEAR_P}.c AS INTEGER) AS center_id,
       {_NEAR_P}.x AS cx, {_NEAR_P}.y AS cy
FROM pt p, kmf i""",
    "centroid_update": _W(S.LTW, S.spread_init("ltw", S.K_MIN, S.K_MAX)) + f"""
SELECT CAST(i.k AS INTEGER) AS k, CAST({_NEAR_P}.c AS INTEGER) AS center_id,
       sum(p.x * p.w) / sum(p.w) AS cx, sum(p.y * p.w) / sum(p.w) AS cy,
       CAST(sum(p.w) AS BIGINT) AS weight
FROM ltw p, init i GROUP BY 1, 2""",
    "convergence_check": _W(S.LTW, S.spread_init("ltw", S.K_MIN, S.K_MAX),
                            S.kmeans_rec("ltw", "init", max_iter=1, weight="w")) + """
SELECT CAST(s.k AS INTEGER) AS k, CAST(len(s.cs) AS INTEGER) AS surviving,
       list_max(list_transform(s.cs, lambda n: sqrt(
           (i.cs[n.c].x - n.x) * (i.cs[n.c].x - n.x) + (i.cs[n.c].y - n.y) * (i.cs[n.c].y - n.y))))
         AS max_move,
       s.done AS converged
FROM km s JOIN init i ON s.k = i.k WHERE s.it = 1""",
    "kmeans_fixed_iters": _W(S.PT, S.spread_init("pt", S.K_MIN, S.K_MAX),
                             S.kmeans_rec("pt", "init", max_iter=FIXED_ITERS), S.kmeans_final()) + """
SELECT CAST(k AS INTEGER) AS k, CAST(u.c AS INTEGER) AS center_id,
       u.x AS cx, u.y AS cy
FROM (SELECT k, unnest(cs) AS u FROM kmf)""",
    "kmeans_converged": _W(*_KM) + """
SELECT CAST(k AS INTEGER) AS k, CAST(it AS INTEGER) AS iterations, done AS converged,
       CAST(len(cs) AS INTEGER) AS surviving FROM kmf""",
    "kmeans_sweep_centers": _W(*_KM) + """
SELECT CAST(k AS INTEGER) AS k, CAST(u.c AS INTEGER) AS center_id,
       u.x AS cx, u.y AS cy
FROM (SELECT k, unnest(cs) AS u FROM kmf)""",
    "wcss_by_k": _W(S.PT, S.spread_init("pt", S.K_MIN, S.K_MAX)) + f"""
SELECT CAST(i.k AS INTEGER) AS k, sum({_NEAR_P}.d) AS wcss FROM pt p, init i GROUP BY 1""",
    "kmeans_wcss_curve": _W(*_KM) + f"""
SELECT CAST(i.k AS INTEGER) AS k, round(sum({_NEAR_P}.d), -1) AS wcss FROM pt p, kmf i GROUP BY 1""",
    "farthest_point": _W(S.PT) + """
SELECT arg_max(p.point_id, {'d': d2, 'n': -p.point_id}) AS point_id,
       arg_max(p.x, {'d': d2, 'n': -p.point_id}) AS x,
       arg_max(p.y, {'d': d2, 'n': -p.point_id}) AS y, max(d2) AS d2
FROM (SELECT p.*, (p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y) AS d2
      FROM pt p, (SELECT x, y FROM pt WHERE point_id = 1) f) p""",
    "kcenter_traversal": _W(*_KC) + """
SELECT CAST(i AS INTEGER) AS center_id, pid AS point_id, x, y, d2 FROM kc""",
    "kcenter_wcss_curve": _W(*_KC) + f"""
, cs AS (SELECT list({{'c': i, 'x': x, 'y': y}} ORDER BY i) AS l FROM kc)
SELECT CAST(g.k AS INTEGER) AS k, sum(m.d) AS wcss, sqrt(max(m.d)) AS radius
FROM range({S.K_MIN}, {S.K_MAX + 1}) g(k), cs,
     LATERAL (SELECT p.point_id, list_min(list_transform(cs.l[1:g.k],
              lambda u: (p.x - u.x) * (p.x - u.x) + (p.y - u.y) * (p.y - u.y))) AS d FROM pt p) m
WHERE g.k <= len(cs.l)
GROUP BY g.k""",
    "elbow_best_k": _W(*_KM, *_KC[1:]) + f"""
, kcl AS (SELECT list({{'c': i, 'x': x, 'y': y}} ORDER BY i) AS l FROM kc),
curve AS (
  SELECT 'kmeans' AS algorithm, i.k, sum({_NEAR_P}.d) AS wcss FROM pt p, kmf i GROUP BY i.k
  UNION ALL
  SELECT 'kcenter', g.k, sum(list_min(list_transform(kcl.l[1:g.k],
         lambda u: (p.x - u.x) * (p.x - u.x) + (p.y - u.y) * (p.y - u.y))))
  FROM range({S.K_MIN}, {S.K_MAX + 1}) g(k), kcl, pt p WHERE g.k <= len(kcl.l) GROUP BY g.k),
d AS (SELECT algorithm, k, wcss - lag(wcss) OVER (PARTITION BY algorithm ORDER BY k) AS diff FROM curve)
SELECT algorithm, CAST(arg_max(k, {{'d': diff, 'n': -k}}) AS INTEGER) AS best_k
FROM d WHERE diff IS NOT NULL GROUP BY algorithm""",
}
