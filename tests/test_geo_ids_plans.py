import json

from conftest import points_df
from locus.operators import geo
from locus.operators.ids import with_sequential_id
from locus.runtime import scratch_path
from locus.sources import geojson


def _regions(spark, features):
    path = scratch_path(spark, "test-geo")
    doc = {"type": "FeatureCollection", "features": features}
    spark.sparkContext.parallelize([json.dumps(doc)], 1).saveAsTextFile(path)
    return geojson.read_regions(spark, path, collection=True)


def feature(name, gtype, coords, reg="R"):
    return {"type": "Feature", "properties": {"prov_name": name, "reg_name": reg},
            "geometry": {"type": gtype, "coordinates": coords}}


def test_point_in_polygon_edges_vertices_holes(spark):
    square_hole = [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]],
                   [[4, 4], [4, 6], [6, 6], [6, 4], [4, 4]]]
    tri2 = [[[[20, 0], [24, 0], [20, 4], [20, 0]]], [[[30, 0], [34, 0], [30, 4], [30, 0]]]]
    regs = _regions(spark, [feature("A", "Polygon", square_hole),
                            feature("B", "MultiPolygon", tri2),
                            feature("A", "Polygon", [[[50, 50], [60, 50], [60, 60], [50, 50]]])])
    provs = geo.first_per_province(regs)
    pts = [(1, 1), (5, 5), (0, 5), (10, 10), (4, 5), (2, 8), (21, 1), (31, 1), (25, 3), (55, 51), (-1, 5)]
    df = points_df(spark, pts).selectExpr("point_id", "x AS lon", "y AS lat")
    got = {(r["prov_name"], r["point_id"]) for r in geo.points_in_polygons(df, provs).collect()}
    # inside: (1,1), (2,8) in A; (21,1), (31,1) in B.  On edge, vertex, in hole, outside: none.
    assert got == {("A", 1), ("A", 6), ("B", 7), ("B", 8)}


def test_polygon_normalised_to_multipolygon(spark):
    regs = _regions(spark, [feature("A", "Polygon", [[[0, 0], [1, 0], [0, 1], [0, 0]]])])
    v = geo.vertices(regs).collect()
    assert {r["poly_id"] for r in v} == {1} and len(v) == 4


def test_features_without_ids_keep_file_order(spark):
    square = lambda x: [[[x, 0], [x + 4, 0], [x + 4, 4], [x, 4], [x, 0]]]
    lines = [{**feature("A", "Polygon", square(0), "first")}, {**feature("A", "Polygon", square(10), "second")},
             {**feature("B", "Polygon", square(20), "b"), "id": "b-17"},
             {**feature("C", "Polygon", square(30), "unnumbered")},
             {**feature("C", "Polygon", square(40), "numbered"), "id": 5}]
    path = scratch_path(spark, "test-geo-lines")
    spark.sparkContext.parallelize([json.dumps(x) for x in lines], 1).saveAsTextFile(path)
    provs = geo.first_per_province(geojson.read_regions(spark, path))
    assert {(r["prov_name"], r["reg_name"]) for r in provs.collect()} == {("A", "first"), ("B", "b"), ("C", "numbered")}
    df = points_df(spark, [(1, 1), (11, 1), (21, 1), (41, 1)]).selectExpr("point_id", "x AS lon", "y AS lat")
    got = geo.region_points(df, provs).select("reg_name", "point_id").collect()
    assert {tuple(r) for r in got} == {("first", 1), ("b", 3), ("numbered", 4)}


def test_polygons_in_degrees_and_salted(spark, monkeypatch):
    # Shapes far smaller than one unit, with and without the broadcast.
    regs = _regions(spark, [feature(f"P{i}", "Polygon", [[[i * .01, 0], [i * .01 + .008, 0], [i * .01 + .008, .008],
                                                          [i * .01, .008], [i * .01, 0]]]) for i in range(20)])
    provs = geo.first_per_province(regs)
    df = points_df(spark, [(i * .01 + .004, .004) for i in range(20)]).selectExpr("point_id", "x AS lon", "y AS lat")
    want = {(f"P{i}", i + 1) for i in range(20)}
    assert {tuple(r) for r in geo.points_in_polygons(df, provs).collect()} == want
    monkeypatch.setattr(geo, "checked_broadcast", lambda small: small)
    assert {tuple(r) for r in geo.points_in_polygons(df, provs).collect()} == want


def test_sequential_ids_dense_and_ordered(spark):
    rows = [(float(x), float(y)) for x in range(30, 0, -1) for y in (2, 1)]
    df = spark.createDataFrame(rows, "x DOUBLE, y DOUBLE").repartition(5)
    out = with_sequential_id(df, ["x", "y"], num_partitions=7).orderBy("point_id").collect()
    assert [r["point_id"] for r in out] == list(range(1, 61))
    assert [(r["x"], r["y"]) for r in out] == sorted(rows)


def test_origin_shift_by_group(spark):
    df = spark.createDataFrame([("a", 5.0, 7.0), ("a", 6.0, 9.0), ("b", -1.0, 2.0)],
                               "g STRING, longitude DOUBLE, latitude DOUBLE")
    got = {(r["g"], r["x"], r["y"]) for r in geo.origin_shift(df, group=["g"]).collect()}
    assert got == {("a", 0.0, 0.0), ("a", 1.0, 2.0), ("b", 0.0, 0.0)}


def test_eps_join_is_an_equi_join(spark):
    from locus.operators import dbscan as db
    df = points_df(spark, [(0, 0), (1, 1)])
    plan = db.eps_neighbors(df, 2.0)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scan_prunes_columns(spark):
    from locus.plans import fixtures as fx
    df = fx.lineitem_points(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in plan


def test_stream_labelling_matches_batch(spark):
    from locus.operators import kmeans as km
    from locus.streaming.assign import read_point_stream, start_labelling
    src = scratch_path(spark, "stream-src")
    pts = points_df(spark, [(0, 0), (9, 9), (1, 0), (8, 9)])
    pts.write.parquet(src)
    centers = [(1, 0.0, 0.0), (2, 10.0, 10.0)]
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    q = start_labelling(read_point_stream(spark, src), centers, out, ck, trigger_once=True)
    q.awaitTermination(120)
    got = {(r["point_id"], r["center_id"]) for r in spark.read.parquet(out).collect()}
    want = {(r["point_id"], r["center_id"]) for r in km.assign(pts, centers).collect()}
    assert got == want == {(1, 1), (2, 2), (3, 1), (4, 2)}
