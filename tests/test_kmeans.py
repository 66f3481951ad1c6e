import random

import pytest

from conftest import points_df
from locus.operators import elbow, kcenter as kc, kmeans as km


def test_tie_goes_to_lowest_center_id(spark):
    pts = points_df(spark, [(0, 0)])
    out = km.assign(pts, [(1, -1.0, 0.0), (2, 1.0, 0.0)]).collect()[0]
    assert out["center_id"] == 1 and out["d2"] == 1.0


def test_lloyd_matches_hand_computation(spark):
    pts = points_df(spark, [(0, 0), (0, 2), (10, 0), (10, 2)])
    fit = km.kmeans(pts, [(1, 0.0, 0.0), (2, 10.0, 0.0)])
    assert fit.converged
    assert sorted(fit.centers) == [(1, 0.0, 1.0), (2, 10.0, 1.0)]
    assert fit.iterations == 2


def test_empty_cluster_vanishes_and_k_shrinks(spark):
    pts = points_df(spark, [(0, 0), (1, 0)])
    fit = km.kmeans(pts, [(1, 0.0, 0.0), (2, 0.5, 0.0), (3, 100.0, 100.0)])
    assert fit.surviving == 2
    assert {c[0] for c in fit.centers} == {1, 2}


def test_all_points_equal(spark):
    pts = points_df(spark, [(3, 4)] * 5)
    fit = km.kmeans(pts, [(1, 3.0, 4.0)])
    assert fit.converged and fit.centers == [(1, 3.0, 4.0)]


def test_weighted_equals_repeated_rows(spark):
    rows = [(0, 0)] * 3 + [(4, 0)] + [(10, 10)] * 2
    plain = points_df(spark, rows)
    w = spark.createDataFrame([(1, 0.0, 0.0, 3), (2, 4.0, 0.0, 1), (3, 10.0, 10.0, 2)],
                              "point_id BIGINT, x DOUBLE, y DOUBLE, w BIGINT")
    init = [(1, 0.0, 0.0), (2, 10.0, 10.0)]
    a = km.kmeans(plain, init)
    b = km.kmeans(w, init, weight="w")
    assert a.centers == b.centers and a.iterations == b.iterations


def test_sweep_equals_single_fits_and_partitioning(spark):
    import random
    rnd = random.Random(7)
    pts = [(rnd.randint(0, 100), rnd.randint(0, 100)) for _ in range(300)]
    df = points_df(spark, pts)
    inits = km.sweep_inits(df, [3, 4, 5])
    sweep = km.kmeans_sweep(df, inits)
    for k in (3, 4, 5):
        assert km.kmeans(df, inits[k]).centers == sweep[k].centers
    for n in (1, 4, 17):
        again = km.kmeans_sweep(df.repartition(n), inits)
        assert {k: f.centers for k, f in again.items()} == {k: f.centers for k, f in sweep.items()}


def test_wcss_never_rises_between_iterations(spark):
    import random
    rnd = random.Random(3)
    df = points_df(spark, [(rnd.randint(0, 50), rnd.randint(0, 50)) for _ in range(200)])
    init = km.init_spread(df, 6)
    fit = km.kmeans_sweep(df, {6: init}, keep_history=True)[6]
    sets = {i: cs for i, cs in enumerate(fit.history + [fit.centers])}
    curve = {r["k"]: r["wcss"] for r in elbow.wcss_curve(df, sets).collect()}
    values = [curve[i] for i in sorted(curve)]
    assert all(b <= a + 1e-9 for a, b in zip(values, values[1:]))


def test_random_init_is_seeded_and_prefix_nested(spark):
    df = points_df(spark, [(i, i * i % 17) for i in range(50)])
    a = km.init_random(df, 8, seed=5)
    b = km.init_random(df.repartition(7), 8, seed=5)
    assert a == b
    assert km.init_random(df, 3, seed=5) == a[:3]
    assert len({(c[1], c[2]) for c in a}) == 8


def test_kcenter_prefix_and_early_stop(spark):
    df = points_df(spark, [(0, 0), (10, 0), (0, 10), (10, 10), (10, 10)])
    steps = kc.kcenter_traversal(df, 10)
    assert len(steps) == 4            # only 4 distinct locations
    assert [s.point_id for s in steps] == [1, 4, 2, 3]  # ties -> lowest id
    radii = [r["radius"] for r in elbow.prefix_curve(df, kc.centers_of(steps), 1, 4)
             .orderBy("k").collect()]
    assert radii == sorted(radii, reverse=True) and radii[-1] == 0.0


def test_best_k_rule(spark):
    curve = spark.createDataFrame([(5, 100.0), (6, 60.0), (7, 50.0), (8, 45.0), (9, 44.0)],
                                  "k INT, wcss DOUBLE")
    # diffs: -40, -10, -5, -1 -> largest is -1 -> k = 9
    assert elbow.best_k(curve).first()[0] == 9


def _brute_traversal(pts, k, first=1):
    """Farthest-first on a list, lowest id on ties; stops at distance 0."""
    chosen = [first]
    while len(chosen) < k:
        best = None
        for i, (x, y) in enumerate(pts, start=1):
            d = min((x - pts[c - 1][0]) * (x - pts[c - 1][0]) + (y - pts[c - 1][1]) * (y - pts[c - 1][1])
                    for c in chosen)
            if best is None or (d, -i) > best:
                best = (d, -i)
        if best[0] <= 0:
            break
        chosen.append(-best[1])
    return chosen


@pytest.mark.parametrize("seed", range(5))
def test_certified_traversal_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    spread = rnd.choice([5, 40, 1000])
    pts = [(rnd.randint(0, spread), rnd.randint(0, spread)) for _ in range(300)]
    df = points_df(spark, pts).repartition(3)
    got = [s.point_id for s in kc.kcenter_traversal(df, 25)]
    assert got == _brute_traversal(pts, 25)


@pytest.mark.parametrize("far", [[(5e8, -3e8)], [(5e8, 0.0), (-9e8, 4e8), (7.0, 6e9)]])
def test_far_outliers_cost_no_more_jobs(spark, monkeypatch, far):
    rnd = random.Random(6)
    pts = [(rnd.randint(0, 1000), rnd.randint(0, 1000)) for _ in range(3000)]
    jobs, real = [], kc.cell_summaries

    def counted(*args, **kw):
        jobs[-1] += 1
        return real(*args, **kw)

    monkeypatch.setattr(kc, "cell_summaries", counted)
    for cloud in (pts, pts + far):
        jobs.append(0)
        got = [s.point_id for s in kc.kcenter_traversal(points_df(spark, cloud), 20 + len(cloud) - len(pts))]
        assert got == _brute_traversal(cloud, 20 + len(cloud) - len(pts))
    # Picking an outlier takes its cell's summary with it: a job each at most.
    assert jobs[1] <= jobs[0] + len(far)


def test_sums_do_not_depend_on_partitions(spark):
    # Random doubles of very different size, weighted: the same bits however the rows are split.
    rnd = random.Random(11)
    rows = [(i + 1, rnd.uniform(-1e6, 1e6) * 10 ** rnd.randint(-6, 0), rnd.random(), rnd.uniform(0.1, 3))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "point_id BIGINT, x DOUBLE, y DOUBLE, w DOUBLE")
    inits = km.sweep_inits(df, [3, 6])
    fits = []
    for n in (1, 7, 17):
        fits.append({k: (f.centers, f.iterations) for k, f in
                     km.kmeans_sweep(df.repartition(n), inits, weight="w", max_iter=15).items()})
    assert fits[0] == fits[1] == fits[2]


def test_update_is_the_exact_mean(spark):
    from fractions import Fraction
    rnd = random.Random(4)
    pts = [(rnd.uniform(-1, 1), rnd.uniform(0, 1e3)) for _ in range(500)]
    got = km.update_centers(points_df(spark, pts).repartition(5), {1: [(1, 0.0, 0.0)]}).first()
    for c, i in (("cx", 0), ("cy", 1)):
        assert got[c] == float(sum(Fraction(p[i]) for p in pts) / len(pts))


def test_farthest_cells_fold_over_many_batches(spark):
    # One partition, many Arrow batches: at most one row per grid cell comes out.
    from locus.functions.centers import cell_farthest_partials
    rnd = random.Random(9)
    pts = [(rnd.randint(0, 1000), rnd.randint(0, 1000)) for _ in range(5000)]
    df = points_df(spark, pts).coalesce(1)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows = cell_farthest_partials(df, [(1, 0.0, 0.0)], (0.0, 0.0, 1000.0, 1000.0, 8)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    best = {}
    for i, (x, y) in enumerate(pts, 1):
        cell = min(int(x / 1000 * 8), 7) * 8 + min(int(y / 1000 * 8), 7)
        best[cell] = max(best.get(cell, (-1, 0)), (float(x * x + y * y), -i))
    assert {r["cell"]: (r["d2"], -r["i"]) for r in rows} == best
    assert len(rows) == len(best)


def test_seeded_draw_has_uneven_gaps(spark):
    df = spark.range(1, 20001).selectExpr("id AS point_id", "CAST(id AS DOUBLE) AS x", "0.0D AS y")
    for seed in (1, 42):
        ids = sorted(r["point_id"] for r in km.sample_frame(df, 20, seed).collect())
        gaps = [b - a for a, b in zip(ids, ids[1:])]
        assert len(set(gaps)) > 15 and max(gaps) > 3 * min(gaps)
