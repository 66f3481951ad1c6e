import math
import random
from collections import deque

import pytest

from conftest import points_df
from locus.operators import dbscan as db


def traversal(pts, eps, min_pts, mode):
    """The reference's visiting order, first-in first-out, on a small list."""
    n = len(pts)

    def nbrs(i):
        return [j for j in range(n) if math.sqrt((pts[i][0] - pts[j][0]) ** 2
                                                 + (pts[i][1] - pts[j][1]) ** 2) <= eps]
    visited, clustered, label, cid = set(), set(), {}, 0
    for i in range(n):
        if i in visited:
            continue
        visited.add(i)
        nb = nbrs(i)
        if len(nb) < min_pts:
            if mode == "order":
                clustered.add(i)
            continue
        cid += 1
        label[i] = cid
        clustered.add(i)
        queue = deque(nb)
        while queue:
            q = queue.popleft()
            if q not in visited:
                visited.add(q)
                nq = nbrs(q)
                if len(nq) >= min_pts:
                    queue.extend(nq)
            if q not in clustered:
                label[q] = cid
                clustered.add(q)
    return {i + 1: c for i, c in label.items()}


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("mode", db.MODES)
def test_matches_traversal(spark, seed, mode):
    rnd = random.Random(seed)
    pts = list({(rnd.randint(-30, 30), rnd.randint(-30, 30)) for _ in range(120)})
    rnd.shuffle(pts)
    eps, min_pts = rnd.choice([3.0, 4.0, 5.0]), rnd.choice([3, 4, 5])
    got = {r["point_id"]: r["cluster_id"]
           for r in db.dbscan(points_df(spark, pts), eps, min_pts, mode).collect()}
    assert got == traversal(pts, eps, min_pts, mode)


def test_grid_join_equals_brute_force(spark):
    rnd = random.Random(11)
    pts = list({(rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(150)})
    eps = 5.0
    got = {(r[0], r[1]) for r in db.eps_neighbors(points_df(spark, pts), eps).collect()}
    want = {(i + 1, j + 1) for i, p in enumerate(pts) for j, q in enumerate(pts)
            if math.sqrt((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) <= eps}
    assert got == want


def test_exactly_eps_counts_and_empty_input(spark):
    df = points_df(spark, [(0, 0), (3, 4), (6, 8)])
    pairs = {(r[0], r[1]) for r in db.eps_neighbors(df, 5.0).collect()}
    assert (1, 2) in pairs and (1, 3) not in pairs
    empty = spark.createDataFrame([], "point_id BIGINT, x DOUBLE, y DOUBLE")
    assert db.dbscan(empty, 1.0, 2).count() == 0


def test_dense_cell_is_core_without_pairs(spark):
    pts = [(i * 0.01, 0.0) for i in range(50)] + [(100.0, 100.0)]
    out = {r["point_id"]: r["role"] for r in db.dbscan(points_df(spark, pts), 1.0, 5).collect()}
    assert all(out[i] == "core" for i in range(1, 51)) and 51 not in out


@pytest.mark.parametrize("mode", db.MODES)
def test_dense_cells_linked_exactly_at_eps(spark, mode):
    # Three dense blobs; A-B closest pair exactly eps apart (a link found only
    # by the point-pair tier), A-C one unit beyond eps (no link).
    blob = [(i, j) for i in range(6) for j in range(6)]
    pts = blob + [(x + 105, y) for x, y in blob] + [(x - 106, y) for x, y in blob]
    got = {r["point_id"]: r["cluster_id"]
           for r in db.dbscan(points_df(spark, pts), 100.0, 5, mode).collect()}
    assert got == traversal(pts, 100.0, 5, mode)
    assert len(set(got.values())) == 2


def test_core_links_tiers_agree_with_pairs(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(5)
    pts = list({(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(400)})
    eps = 7.0
    df = db.with_cells(points_df(spark, pts), eps)
    cells = df.groupBy("gx", "gy").agg(F.min("point_id").alias("node"))
    core_n = df.join(cells, ["gx", "gy"])
    got = {tuple(sorted(r)) for r in db.core_links(core_n, eps).collect()}
    rows = core_n.collect()
    want = {tuple(sorted((a["node"], b["node"]))) for a in rows for b in rows
            if a["node"] != b["node"]
            and math.sqrt((a["x"] - b["x"]) ** 2 + (a["y"] - b["y"]) ** 2) <= eps}
    assert got == want


def test_no_all_pairs_join_in_any_stage(spark, monkeypatch):
    # Every intermediate table DBSCAN writes (cells, tiers, component rounds)
    # is planned with equi-joins only.
    import locus.runtime as rt
    from locus.operators import components, ids
    seen = []

    def checked(df, name="stage", path=None):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        seen.append(name)
        return rt.materialize(df, name, path)

    for mod in (db, components, ids):
        monkeypatch.setattr(mod, "materialize", checked)
    rnd = random.Random(2)
    pts = list({(rnd.randint(0, 50), rnd.randint(0, 50)) for _ in range(300)})
    assert db.dbscan(points_df(spark, pts), 4.0, 4).count() > 0
    assert {"db-cell-pairs", "db-sub-pairs", "db-point-box", "cc-edges"} <= set(seen)


@pytest.mark.parametrize("mode", db.MODES)
def test_sparse_points_next_to_whole_dense_cell(spark, mode):
    # A tight dense clump (one cell) and sparse points around it: some see the
    # whole clump within eps (counted and seeded per cell, no pair tests),
    # some only part of it, some none.  Ids interleave so border order matters.
    clump = [(50 + i % 3, 50 + i // 3) for i in range(9)]
    sparse = [(58, 50), (50, 59), (60, 60), (42, 44), (70, 50), (50, 38), (61, 52)]
    pts = sparse[:3] + clump + sparse[3:]
    got = {r["point_id"]: r["cluster_id"]
           for r in db.dbscan(points_df(spark, pts), 10.0, 4, mode).collect()}
    assert got == traversal(pts, 10.0, 4, mode)
    assert len(got) > len(clump)


def test_rows_at_one_place_are_one_point(spark):
    # Five copies are one neighbour, not five: no core; every row gets its point's label.
    df = points_df(spark, [(0, 0)] * 5)
    parts = db.dbscan_parts(df, 1.0, 5)
    assert parts.core.count() == 0
    rows = db.labels_of_rows(df, parts).collect()
    assert len(rows) == 5 and all(r["role"] == "noise" and r["cluster_id"] is None for r in rows)


def test_horseshoe_is_one_cluster(spark):
    # Two long arms joined at the far end: the chain is longer than any fixed number of rounds.
    n = 260
    pts = [(0.6 * i, 0) for i in range(n)] + [(0.6 * n, 0.6 * j) for j in range(6)] + [(0.6 * i, 3) for i in range(n, -1, -1)]
    df = spark.createDataFrame([(i + 1, float(x), float(y)) for i, (x, y) in enumerate(pts)],
                               "point_id BIGINT, x DOUBLE, y DOUBLE")
    got = db.dbscan(df, 1.0, 2).select("cluster_id").distinct().collect()
    assert [r["cluster_id"] for r in got] == [1]


def test_hot_cell_beside_sparse_points(spark, monkeypatch):
    # A third of the points in one cell, sparse points all around it at the edge of eps.
    rnd = random.Random(21)
    hot = {(round(rnd.uniform(0, 6.9), 4), round(rnd.uniform(0, 6.9), 4)) for _ in range(500)}
    ring = {(round(3.5 + r * math.cos(a), 4), round(3.5 + r * math.sin(a), 4))
            for a in [rnd.uniform(0, 6.28) for _ in range(400)] for r in [rnd.uniform(10, 60)]}
    pts = sorted(hot | ring)
    rows = {}

    def counted(df, name="stage", path=None):
        out = real(df, name, path)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    real = db.materialize
    monkeypatch.setattr(db, "materialize", counted)
    got = {(r["point_id"], r["role"]) for r in db.dbscan(points_df(spark, pts), 10.0, 6, "canonical").collect()}
    assert max(rows.values()) <= 24 * len(pts) and rows["db-dense-counts"] <= 24 * len(ring)
    near = [[math.dist(p, q) <= 10.0 for q in pts] for p in pts]
    core = {i for i, n in enumerate(near) if sum(n) >= 6}
    assert {i - 1 for i, r in got if r == "core"} == core
    assert {i - 1 for i, r in got if r == "border"} == {i for i in range(len(pts)) if i not in core
                                                          and any(near[i][j] for j in core)}
