"""Property tests (few examples each: every example runs Spark jobs)."""

import math
import random

from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import points_df
from locus.operators import dbscan as db, elbow, kcenter as kc, kmeans as km

SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
POINTS = st.lists(st.tuples(st.integers(-40, 40), st.integers(-40, 40)),
                  min_size=8, max_size=60, unique=True)


@SETTINGS
@given(pts=POINTS)
def test_kcenter_radius_never_rises_and_prefixes_nest(spark, pts):
    df = points_df(spark, pts)
    steps = kc.kcenter_traversal(df, 8)
    shorter = kc.kcenter_traversal(df, 5)
    assert [s.point_id for s in shorter] == [s.point_id for s in steps][:5]
    curve = elbow.prefix_curve(df, kc.centers_of(steps), 1, len(steps)).collect()
    radius = [r["radius"] for r in sorted(curve, key=lambda r: r["k"])]
    assert all(b <= a for a, b in zip(radius, radius[1:]))


@SETTINGS
@given(pts=POINTS, seed=st.integers(0, 10_000))
def test_dbscan_core_clusters_invariant_under_reordering(spark, pts, seed):
    # Canonical mode, core points: the partition into clusters does not depend
    # on row order (cluster numbers may be renamed).
    eps, min_pts = 6.0, 3

    def groups(rows):
        lab = {rows[r["point_id"] - 1]: r["cluster_id"]
               for r in db.dbscan(points_df(spark, rows), eps, min_pts, "canonical").collect()
               if r["role"] == "core"}
        by = {}
        for p, c in lab.items():
            by.setdefault(c, set()).add(p)
        return {frozenset(v) for v in by.values()}

    shuffled = pts[:]
    random.Random(seed).shuffle(shuffled)
    assert groups(pts) == groups(shuffled)


def test_dbscan_partition_independence(spark):
    rnd = random.Random(9)
    pts = list({(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(250)})
    base = points_df(spark, pts)
    runs = [sorted(tuple(r) for r in db.dbscan(base.repartition(n), 5.0, 4).collect())
            for n in (1, 4, 17)]
    assert runs[0] == runs[1] == runs[2]


def test_wcss_agrees_with_spark_ml_on_separated_blobs(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    rnd = random.Random(4)
    centres = [(0, 0), (1000, 0), (0, 1000)]
    pts = list({(cx + rnd.randint(-20, 20), cy + rnd.randint(-20, 20))
                for cx, cy in centres for _ in range(60)})
    df = points_df(spark, pts).cache()
    fit = km.kmeans_sweep(df, km.sweep_inits(df, [3]))[3]
    ours = elbow.wcss_curve(df, {3: fit.centers}).collect()[0]["wcss"]
    vec = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    model = KMeans(k=3, seed=1, maxIter=100, tol=1e-9).fit(vec)
    theirs = model.summary.trainingCost
    assert math.isclose(ours, theirs, rel_tol=1e-9)
