"""Point in polygon in degrees against fractions, and the levels of the grid."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from locus.operators import geo

SCHEMA = "prov_name STRING, reg_name STRING, feature_id BIGINT, geometry ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"


def inside(px, py, rings):
    """Winding over fractions: strictly inside, the boundary is outside."""
    px, py = Fraction(px), Fraction(py)
    odd = False
    for ring in rings:
        pts = [(Fraction(a), Fraction(b)) for a, b in ring]
        for (x1, y1), (x2, y2) in zip(pts, pts[1:]):
            cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
            if cross == 0 and (px - x1) * (px - x2) <= 0 and (py - y1) * (py - y2) <= 0:
                return False
            if y1 != y2 and min(y1, y2) <= py < max(y1, y2) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def check(spark, provinces, points):
    """provinces: name -> rings."""
    regions = spark.createDataFrame([(name, "r", i, [rings]) for i, (name, rings) in enumerate(provinces.items())], SCHEMA)
    pts = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "point_id BIGINT, lon DOUBLE, lat DOUBLE")
    got = {(r["prov_name"], r["point_id"]) for r in geo.points_in_polygons(pts, regions).collect()}
    want = {(name, i) for name, rings in provinces.items() for i, (x, y) in enumerate(points) if inside(x, y, rings)}
    assert got == want
    return got


def test_points_on_edges_in_degrees_are_classified_as_fractions_do(spark):
    rnd = random.Random(7)
    star = [(11.1 + 0.3 * (i % 3) + 0.07 * i, 45.2 + 0.11 * ((i * 7) % 10)) for i in range(9)]
    ring = [[a, b] for a, b in star] + [list(star[0])]
    hole = [[11.5, 45.6], [11.7, 45.61], [11.6, 45.8], [11.5, 45.6]]
    points = [tuple(v) for v in ring]
    for (x1, y1), (x2, y2) in zip(ring + hole, ring[1:] + hole[1:] + [hole[0]]):
        for _ in range(40):
            t = rnd.random()
            x, y = x1 + t * (x2 - x1), y1 + t * (y2 - y1)
            # On the edge as nearly as doubles allow, and one step to each side.
            points += [(x, y), (x + rnd.choice([-1, 1]) * 2.0 ** -49, y), (x, y + rnd.choice([-1, 1]) * 2.0 ** -47)]
        points.append(((x1 + x2) / 2, (y1 + y2) / 2))
    assert check(spark, {"star": [ring, hole]}, points)


def test_doubles_alone_would_be_wrong(spark):
    # A sliver beside the line through (0.5, 0.5), (12, 12), (24, 24): the sign of the plain determinant is noise there.
    tri = [[12.0, 12.0], [24.0, 24.0], [12.0, 30.0], [12.0, 12.0]]
    points = [(12.0 + i * 2.0 ** -49 + 6, 12.0 + j * 2.0 ** -49 + 6) for i in range(24) for j in range(24)]
    check(spark, {"t": [tri]}, points)


def test_whole_numbers_never_leave_the_jvm(spark, monkeypatch):
    def fail(batches):
        for b in batches:
            assert b.num_rows == 0
            yield b

    monkeypatch.setattr(geo, "_exactly", fail)
    square = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [5.0, 5.0], [0.0, 10.0], [0.0, 0.0]]
    assert check(spark, {"q": [square]}, [(x, y) for x in range(-1, 12) for y in range(-1, 12)])


def test_a_box_takes_at_most_four_cells_of_its_level(spark):
    rnd = random.Random(3)
    boxes = [(f"p{i}", x, x + w, y, y + h) for i in range(200)
             for x, y, w, h in [(rnd.uniform(-180, 180), rnd.uniform(-90, 90), 10 ** rnd.uniform(-6, 3), 10 ** rnd.uniform(-6, 3))]]
    boxes += [("dot", 4.0, 4.0, 5.0, 5.0), ("line", 1.0, 1.0, 0.0, 8.0)]
    df = spark.createDataFrame(boxes, "prov_name STRING, bx0 DOUBLE, bx1 DOUBLE, by0 DOUBLE, by1 DOUBLE")
    rows = geo.box_cells(df).groupBy("prov_name").agg(F.count("*").alias("n"), F.countDistinct("level").alias("levels")).collect()
    assert len(rows) == len(boxes) and all(r["n"] <= 4 and r["levels"] == 1 for r in rows)


def test_one_province_a_thousand_times_the_others(spark):
    rnd = random.Random(5)
    huge = [[-1000.0, -1000.0], [1000.0, -1000.0], [1000.0, 1000.0], [0.0, 900.0], [-1000.0, 1000.0], [-1000.0, -1000.0]]
    provinces = {"huge": [huge]}
    for i in range(12):
        x, y = rnd.uniform(-20, 20), rnd.uniform(-20, 20)
        provinces[f"p{i}"] = [[[x, y], [x + 2, y], [x + 1.3, y + 1.7], [x, y]]]
    points = [(rnd.uniform(-22, 22), rnd.uniform(-22, 22)) for _ in range(300)] + [(0.0, 950.0), (0.0, 900.0), (999.0, -999.0)]
    assert check(spark, provinces, points)


@pytest.mark.parametrize("n", [0, 1])
def test_no_regions_or_no_points(spark, n):
    tri = [[0.0, 0.0], [1.5, 0.0], [0.0, 1.5], [0.0, 0.0]]
    check(spark, {"t": [tri]} if n else {}, [] if n else [(0.1, 0.1)])
