"""The compressed neighbour relation and the links of core cells, against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import points_df
from locus.operators import boxpairs as bp, dbscan as db


def all_pairs(pts, eps):
    return {(i + 1, j + 1) for i, p in enumerate(pts) for j, q in enumerate(pts)
            if math.sqrt((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) <= eps}


CLOUDS = {
    "lattice": lambda rnd: list({(rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(220)}),
    "two clumps and a ring": lambda rnd: list({(round(rnd.gauss(c, 0.4), 3), round(rnd.gauss(c, 0.4), 3)) for c in (0, 4) for _ in range(70)}
                                              | {(round(5 * math.cos(t / 9), 3), round(5 * math.sin(t / 9), 3)) for t in range(57)}),
    "negative and tiny": lambda rnd: list({(rnd.uniform(-3, 3) * 10.0 ** -rnd.randint(0, 9), rnd.uniform(-9, 9)) for _ in range(150)}),
}


@pytest.mark.parametrize("cloud", CLOUDS)
@pytest.mark.parametrize("most", [1024, 8])
def test_relation_equals_all_pairs(spark, monkeypatch, cloud, most):
    monkeypatch.setattr(db, "PAIRS", most)
    pts = CLOUDS[cloud](random.Random(3))
    relation = db.eps_relation(points_df(spark, pts), 5.0)
    want = all_pairs(pts, 5.0)
    got = [tuple(r) for r in relation.expand().collect()]
    assert len(got) == len(set(got)) and set(got) == want
    counts = {r["point_id"]: r["n_neighbors"] for r in relation.counts().collect()}
    assert counts == {i + 1: sum(a == i + 1 for a, _ in want) for i in range(len(pts))}


def test_a_hot_cell_takes_linear_rows(spark):
    # n points in one cell, a few sparse ones at the edge of eps around it.
    rnd = random.Random(5)
    n = 3000
    hot = list({(rnd.uniform(0, 0.7), rnd.uniform(0, 0.7)) for _ in range(n)})
    pts = hot + [(0.35 + math.cos(t), 0.35 + math.sin(t)) for t in range(8)]
    relation = db.eps_relation(points_df(spark, pts), 1.0)
    stored = relation.blocks.count() + relation.pairs.count()
    assert stored <= 2 * 8 * n
    counts = {r["point_id"]: r["n_neighbors"] for r in relation.counts().collect()}
    xy = np.array(pts)
    for i in [0, 17, n - 1, *range(n, len(pts))]:
        d = xy - xy[i]
        assert counts[i + 1] == int((np.sqrt(d[:, 0] ** 2 + d[:, 1] ** 2) <= 1.0).sum())


def test_no_points_and_one_place(spark):
    empty = spark.createDataFrame([], "point_id BIGINT, x DOUBLE, y DOUBLE")
    assert db.neighbor_counts(empty, 1.0).count() == 0
    assert [tuple(r) for r in db.neighbor_counts(points_df(spark, [(2, 2)] * 4), 1.0).collect()] == [(1, 1)]


def test_boxes_nest(spark):
    rnd = random.Random(1)
    df = db.with_cells(points_df(spark, [(rnd.uniform(-50, 50), rnd.uniform(-50, 50)) for _ in range(500)]), 7.0)
    side = db.cell_side(7.0)
    for level in (0, 1, 4, 11, 23):
        a = bp.placed(df, side, level).select("point_id", F.col("sx").alias("ux"), F.col("sy").alias("uy"))
        both = bp.placed(df, side, level + 1).join(a, "point_id")
        assert both.filter(f"sx div {bp.SUB} <> ux OR sy div {bp.SUB} <> uy").isEmpty()


def core_cells(spark, pts, eps):
    df = db.with_cells(points_df(spark, pts), eps)
    nodes = df.groupBy("gx", "gy").agg(F.min("point_id").alias("node"))
    return df.join(nodes, ["gx", "gy"])


@pytest.mark.parametrize("bound", [1 << 16, 40])
def test_links_equal_all_pairs(spark, monkeypatch, bound):
    # With a small bound boxes are refined over several levels in Spark.
    monkeypatch.setattr(db, "LINK_POINTS", bound)
    monkeypatch.setattr(db, "LINK_PAIRS", 16)
    for seed in (1, 2):
        rnd = random.Random(seed)
        pts = list({(round(rnd.uniform(0, 30), 2), round(rnd.uniform(0, 30), 2)) for _ in range(500)})
        core_n = core_cells(spark, pts, 7.0)
        node = {r["point_id"]: r["node"] for r in core_n.collect()}
        want = {tuple(sorted((node[a], node[b]))) for a, b in all_pairs(pts, 7.0) if node[a] != node[b]}
        assert {tuple(sorted(r)) for r in db.core_links(core_n, 7.0).collect()} == want


def clump(n, x0, rnd, edge=()):
    return [(x0 + rnd.uniform(0, 0.3), rnd.uniform(0, 0.3)) for _ in range(n)] + list(edge)


@pytest.mark.parametrize("apart", [1.0, math.nextafter(1.0, 2)])
def test_pairs_tested_between_two_clumps_are_linear(spark, apart):
    # Their nearest points exactly eps, or a hair more, apart.
    per_point = []
    for n in (1000, 4000):
        rnd = random.Random(n)
        pts = clump(n, 0.0, rnd, [(0.3, 0.15)]) + clump(n, 0.3 + apart, rnd, [(0.3 + apart, 0.15)])
        pts = [p for p in pts if p[0] != 0.3 + apart or p[1] == 0.15]
        stats = {}
        links = db.core_links(core_cells(spark, pts, 1.0), 1.0, stats).collect()
        assert any((r["src"] <= n + 1) != (r["dst"] <= n + 1) for r in links) == (math.sqrt((0.3 + apart - 0.3) ** 2) <= 1.0)
        per_point.append(stats["tests"] / (2 * n))
    assert max(per_point) <= 40 and per_point[1] <= 2 * max(per_point[0], 1)


def test_nearest_within_counts_its_tests():
    rng = np.random.default_rng(4)
    for n in (2000, 20000):
        a, b = rng.uniform(0, 1, (n, 2)), rng.uniform(0, 1, (n, 2)) + [2.0, 0.0]
        least = min(b[:, 0].min() - a[:, 0].max(), 2.0)
        for eps in (least * 0.999, 1.2, 1.0):
            found, tests = db.nearest_within(a, b, eps)
            d2 = [(b - p) ** 2 for p in a[a[:, 0] > 1 - (eps - 1) - 0.01]] if eps >= 1 else []
            assert found == any((np.sqrt(d.sum(axis=1)) <= eps).any() for d in d2)
            assert tests <= 40 * n
