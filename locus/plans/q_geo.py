"""Queries for geographic preparation and for the point/assignment/curve sinks.

Region fixture RG (derived from ``supplier``, ``nation``, ``region``): one
GeoJSON feature per supplier, ``id`` = s_suppkey, province = its nation's
name, region = that nation's region name.  The shape comes from a fixed
template chosen by the region key, placed at
(1000 + 2000 * n_nationkey, 2000 + 4 * floor(s_acctbal + 1000)) in units of
PT's plane, template unit 1500.  Features are written as newline-delimited
GeoJSON and read back through the S4 scan; J5 keeps each province's first
feature.  Points: PT with lon = x, lat = y.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from locus.operators import elbow, geo, kcenter as kc, kmeans as km
from locus.plans import fixtures as fx
from locus.plans.q_partitional import _pt, _sweep, _traversal
from locus.plans import sqlparts as S
from locus.runtime import scratch_path
from locus.sources import geojson, points as P

UNIT = 1500.0

# Shape template rows (shape, poly_id, ring_id, seq, ux, uy), in
# template units.  Shapes by region key: 0 square, 1 square with a square hole,
# 2 two triangles (MultiPolygon), 3 concave L, 4 square as a one-polygon
# MultiPolygon.  Rings are closed (last vertex = first).
SHAPE_TEMPLATE = [
    (0, 1, 1, 1, -2, -2), (0, 1, 1, 2, 2, -2), (0, 1, 1, 3, 2, 2), (0, 1, 1, 4, -2, 2), (0, 1, 1, 5, -2, -2),
    (1, 1, 1, 1, -2, -2), (1, 1, 1, 2, 2, -2), (1, 1, 1, 3, 2, 2), (1, 1, 1, 4, -2, 2), (1, 1, 1, 5, -2, -2),
    (1, 1, 2, 1, -1, -1), (1, 1, 2, 2, -1, 1), (1, 1, 2, 3, 1, 1), (1, 1, 2, 4, 1, -1), (1, 1, 2, 5, -1, -1),
    (2, 1, 1, 1, -2, -2), (2, 1, 1, 2, 0, -2), (2, 1, 1, 3, -2, 0), (2, 1, 1, 4, -2, -2),
    (2, 2, 1, 1, 2, 2), (2, 2, 1, 2, 0, 2), (2, 2, 1, 3, 2, 0), (2, 2, 1, 4, 2, 2),
    (3, 1, 1, 1, -2, -2), (3, 1, 1, 2, 2, -2), (3, 1, 1, 3, 2, 0), (3, 1, 1, 4, 0, 0), (3, 1, 1, 5, 0, 2),
    (3, 1, 1, 6, -2, 2), (3, 1, 1, 7, -2, -2),
    (4, 1, 1, 1, -2, -2), (4, 1, 1, 2, 2, -2), (4, 1, 1, 3, 2, 2), (4, 1, 1, 4, -2, 2), (4, 1, 1, 5, -2, -2),
]
MULTI_SHAPES = (2, 4)
FOCUS_REGION = "EUROPE"


def _template(spark):
    return spark.createDataFrame(
        SHAPE_TEMPLATE, "shape INT, poly_id INT, ring_id INT, seq INT, ux INT, uy INT")


def feature_vertices(spark, sf_dir):
    """Vertex rows of every feature: one per supplier."""
    feats = (fx.table(spark, sf_dir, "supplier")
             .join(fx.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
             .join(fx.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
             .select(F.col("s_suppkey").alias("feature_id"), F.col("n_name").alias("prov_name"),
                     F.col("r_name").alias("reg_name"), F.col("n_regionkey").alias("shape"),
                     (F.lit(1000) + 2000 * F.col("n_nationkey")).cast("double").alias("cx"),
                     (F.lit(2000) + 4 * F.floor(F.col("s_acctbal") + 1000)).cast("double").alias("cy")))
    # The template is a fixed 35-row table: a bounded broadcast.
    return (feats.join(F.broadcast(_template(spark)), "shape")
            .select("feature_id", "prov_name", "reg_name", "shape", "poly_id", "ring_id", "seq",
                    (F.col("cx") + F.col("ux") * UNIT).alias("lon"),
                    (F.col("cy") + F.col("uy") * UNIT).alias("lat")))


def build_features(vertices):
    """Vertex rows -> (feature_id, prov_name, reg_name, geom_type, coords_json)."""
    ring = (vertices.groupBy("feature_id", "prov_name", "reg_name", "shape", "poly_id", "ring_id")
            .agg(F.sort_array(F.collect_list(F.struct("seq", F.array("lon", "lat").alias("v")))).alias("vs"))
            .withColumn("ring", F.col("vs.v")))
    poly = (ring.groupBy("feature_id", "prov_name", "reg_name", "shape", "poly_id")
            .agg(F.sort_array(F.collect_list(F.struct("ring_id", "ring"))).alias("rs"))
            .withColumn("poly", F.col("rs.ring")))
    geom = (poly.groupBy("feature_id", "prov_name", "reg_name", "shape")
            .agg(F.sort_array(F.collect_list(F.struct("poly_id", "poly"))).alias("ps"))
            .withColumn("geometry", F.col("ps.poly")))
    multi = F.col("shape").isin(*MULTI_SHAPES)
    return geom.select(
        "feature_id", "prov_name", "reg_name",
        F.when(multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")).alias("geom_type"),
        F.when(multi, F.to_json("geometry")).otherwise(F.to_json(F.col("geometry")[0])).alias("coords_json"))


def regions(spark, sf_dir):
    """RG written as GeoJSON features and scanned back (S4): all features."""
    path = scratch_path(spark, "regions")
    geojson.write_features(build_features(feature_vertices(spark, sf_dir)), path)
    return geojson.read_regions(spark, path)


def provinces(spark, sf_dir):
    return geo.first_per_province(regions(spark, sf_dir))


def _pt_lonlat(spark, sf_dir):
    return _pt(spark, sf_dir).select("point_id", F.col("x").alias("lon"), F.col("y").alias("lat"))


# ------------------------------------------------------------------ queries

def origin_shift_global(spark, sf_dir):
    lt = fx.lineitem_points(spark, sf_dir).select(F.col("x").alias("longitude"),
                                                  F.col("y").alias("latitude"))
    return geo.origin_shift(lt)


def origin_shift_by_group(spark, sf_dir):
    bp = fx.brand_points(spark, sf_dir).select("p_partkey", "p_brand", F.col("x").alias("longitude"),
                                               F.col("y").alias("latitude"))
    return geo.origin_shift(bp, group=["p_brand"]).select("p_partkey", "p_brand", "x", "y")


def geo_polygon_normalize(spark, sf_dir):
    return geo.vertices(provinces(spark, sf_dir))


def geo_collection_normalize(spark, sf_dir):
    """S4 + J5: the same features as FeatureCollection documents, read by split."""
    path = scratch_path(spark, "collection")
    geojson.write_collections(build_features(feature_vertices(spark, sf_dir)), path)
    return geo.vertices(geo.first_per_province(geojson.read_regions(spark, path, collection=True)))


def geo_province_sink_roundtrip(spark, sf_dir):
    """The points of every province, shifted to its origin, in a folder for each region and province, and read back."""
    path = scratch_path(spark, "province-points")
    rp = geo.region_points(_pt_lonlat(spark, sf_dir), provinces(spark, sf_dir))
    P.write_points(rp.select("reg_name", "prov_name", "point_id", "x", "y"), path, ["reg_name", "prov_name"])
    return spark.read.option("header", True).schema("point_id BIGINT, x DOUBLE, y DOUBLE, reg_name STRING, prov_name STRING").csv(path)


def geo_region_provinces(spark, sf_dir):
    return geo.region_provinces(regions(spark, sf_dir))


def geo_point_in_polygon(spark, sf_dir):
    return geo.points_in_polygons(_pt_lonlat(spark, sf_dir), provinces(spark, sf_dir))


def geo_region_points(spark, sf_dir):
    return geo.region_points(_pt_lonlat(spark, sf_dir), provinces(spark, sf_dir))


def geo_region_union(spark, sf_dir):
    rp = geo.region_points(_pt_lonlat(spark, sf_dir), provinces(spark, sf_dir))
    return geo.region_union(rp)


def csv_points_scan(spark, sf_dir):
    """Part points as a prepared file, where parts over size 45 have no usable x; bad rows are left out."""
    bp = fx.brand_points(spark, sf_dir)
    bad = F.element_at(F.array(F.lit("n/a"), F.lit("NaN"), F.lit("Infinity"), F.lit("")), (F.col("p_partkey") % 4 + 1).cast("int"))
    path = scratch_path(spark, "prepared")
    P.write_points(bp.select(F.col("x").alias("longitude"), F.col("y").alias("latitude"),
                             F.when(F.col("x") > 45000, bad).otherwise(F.col("x").cast("string")).alias("x"), "y"), path)
    return P.read_points(spark, path)


def raw_places_prepared(spark, sf_dir):
    """Raw places written as CSV, read, shifted to their origin, written and read as a prepared file."""
    raw, prepared = scratch_path(spark, "raw"), scratch_path(spark, "prepared")
    P.write_points(fx.lineitem_points(spark, sf_dir).select(
        F.col("x").alias("longitude"), F.col("y").alias("latitude"), F.lit(1.0).alias("ita_general_2020")), raw)
    shifted = geo.origin_shift(P.read_raw_places(spark, raw))
    P.write_points(shifted.select("longitude", "latitude", "x", "y"), prepared)
    return P.read_points(spark, prepared, extra=["longitude", "latitude"])


def points_sink_roundtrip(spark, sf_dir):
    """Points written as header CSV, one folder per brand, read back."""
    bp = fx.brand_points(spark, sf_dir)
    path = scratch_path(spark, "points")
    P.write_points(bp, path, partition_by=["p_brand"])
    schema = "p_partkey BIGINT, x DOUBLE, y DOUBLE, p_brand STRING"
    return spark.read.option("header", True).schema(schema).csv(path) \
        .select("p_partkey", "p_brand", "x", "y")


def assignment_sink_roundtrip(spark, sf_dir):
    """X,y,cx,cy lines per k (no header), read back with k from folders."""
    pt = _pt(spark, sf_dir)
    fits = _sweep(pt)
    lab = km.assign_all_k(pt, {k: f.centers for k, f in fits.items()})
    path = scratch_path(spark, "assign")
    P.write_assignments(lab, path)
    return P.read_assignments(spark, path).select("k", "x", "y", "cx", "cy")


def wcss_sink_roundtrip(spark, sf_dir):
    """The K-Center curve as k,wcss lines, read back."""
    pt = _pt(spark, sf_dir)
    curve = elbow.prefix_curve(pt, kc.centers_of(_traversal(pt)), S.K_MIN, S.K_MAX)
    path = scratch_path(spark, "wcss")
    P.write_wcss(curve, path)
    return P.read_wcss(spark, path)


QUERIES = {
    "origin_shift_global": origin_shift_global,
    "origin_shift_by_group": origin_shift_by_group,
    "geo_polygon_normalize": geo_polygon_normalize,
    "geo_collection_normalize": geo_collection_normalize,
    "geo_province_sink_roundtrip": geo_province_sink_roundtrip,
    "geo_region_provinces": geo_region_provinces,
    "geo_point_in_polygon": geo_point_in_polygon,
    "geo_region_points": geo_region_points,
    "geo_region_union": geo_region_union,
    "csv_points_scan": csv_points_scan,
    "raw_places_prepared": raw_places_prepared,
    "points_sink_roundtrip": points_sink_roundtrip,
    "assignment_sink_roundtrip": assignment_sink_roundtrip,
    "wcss_sink_roundtrip": wcss_sink_roundtrip,
}

# ---------------------------------------------------------------- oracle SQL

_TPL = ", ".join(f"({a}, {b}, {c}, {d}, {e}, {f})" for a, b, c, d, e, f in SHAPE_TEMPLATE)

_GEO = S.with_recursive(
    S.PT,
    f"tpl(shape, poly_id, ring_id, seq, ux, uy) AS (VALUES {_TPL})",
    """feat AS (
  SELECT s.s_suppkey AS feature_id, n.n_name AS prov_name, r.r_name AS reg_name, n.n_regionkey AS shape,
         CAST(1000 + 2000 * n.n_nationkey AS DOUBLE) AS cx,
         CAST(2000 + 4 * floor(s.s_acctbal + 1000) AS DOUBLE) AS cy
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    "firstf AS (SELECT * FROM feat WHERE feature_id IN (SELECT min(feature_id) FROM feat GROUP BY prov_name))",
    f"""vert AS (
  SELECT f.prov_name, f.reg_name, f.feature_id, CAST(t.poly_id AS INTEGER) AS poly_id,
         CAST(t.ring_id AS INTEGER) AS ring_id, CAST(t.seq AS INTEGER) AS seq,
         f.cx + t.ux * {UNIT} AS lon, f.cy + t.uy * {UNIT} AS lat
  FROM firstf f JOIN tpl t ON t.shape = f.shape)""",
    """edge AS (
  SELECT a.prov_name, a.lon AS x1, a.lat AS y1, b.lon AS x2, b.lat AS y2
  FROM vert a JOIN vert b ON a.prov_name = b.prov_name AND a.poly_id = b.poly_id
   AND a.ring_id = b.ring_id AND b.seq = a.seq + 1)""",
    """pip AS (
  SELECT e.prov_name, p.point_id
  FROM pt p, edge e
  GROUP BY e.prov_name, p.point_id
  HAVING sum(CASE WHEN ((e.y1 > p.y) <> (e.y2 > p.y)) AND
                       CASE WHEN e.y2 > e.y1 THEN (p.x - e.x1) * (e.y2 - e.y1) < (p.y - e.y1) * (e.x2 - e.x1)
                            ELSE (p.x - e.x1) * (e.y2 - e.y1) > (p.y - e.y1) * (e.x2 - e.x1) END
                  THEN 1 ELSE 0 END) % 2 = 1
     AND max(CASE WHEN (e.x2 - e.x1) * (p.y - e.y1) - (e.y2 - e.y1) * (p.x - e.x1) = 0
                   AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                   AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)
                  THEN 1 ELSE 0 END) = 0)""",
    """rp AS (
  SELECT f.reg_name, i.prov_name, i.point_id, p.x AS lon, p.y AS lat,
         p.x - min(p.x) OVER (PARTITION BY i.prov_name) AS x,
         p.y - min(p.y) OVER (PARTITION BY i.prov_name) AS y
  FROM pip i JOIN pt p USING (point_id) JOIN firstf f USING (prov_name))""",
)

ORACLE = {
    "origin_shift_global": """
SELECT longitude, latitude, longitude - min(longitude) OVER () AS x, latitude - min(latitude) OVER () AS y
FROM (SELECT CAST(CAST(l_quantity * 1000 AS BIGINT) AS DOUBLE) AS longitude,
             CAST(CAST(floor(l_extendedprice) AS BIGINT) AS DOUBLE) AS latitude FROM lineitem) t""",
    "origin_shift_by_group": """
SELECT p_partkey, p_brand, x - min(x) OVER (PARTITION BY p_brand) AS x, y - min(y) OVER (PARTITION BY p_brand) AS y
FROM (SELECT p_partkey, p_brand, CAST(CAST(p_size * 1000 AS BIGINT) AS DOUBLE) AS x,
             CAST(CAST(round((p_retailprice - 900) * 500) AS BIGINT) AS DOUBLE) AS y FROM part) t""",
    "geo_polygon_normalize": _GEO + "SELECT * FROM vert",
    "geo_collection_normalize": _GEO + "SELECT * FROM vert",
    "geo_province_sink_roundtrip": _GEO + "SELECT reg_name, prov_name, point_id, x, y FROM rp",
    "geo_region_provinces": _GEO + "SELECT DISTINCT reg_name, prov_name FROM feat",
    "geo_point_in_polygon": _GEO + "SELECT prov_name, point_id FROM pip",
    "geo_region_points": _GEO + "SELECT * FROM rp",
    "geo_region_union": _GEO + """
SELECT reg_name, point_id, lon, lat, lon - min(lon) OVER (PARTITION BY reg_name) AS x,
       lat - min(lat) OVER (PARTITION BY reg_name) AS y
FROM (SELECT DISTINCT reg_name, point_id, lon, lat FROM rp) d""",
    "csv_points_scan": """
SELECT x, y FROM (SELECT CAST(CAST(p_size * 1000 AS BIGINT) AS DOUBLE) AS x,
                         CAST(CAST(round((p_retailprice - 900) * 500) AS BIGINT) AS DOUBLE) AS y FROM part) t
WHERE x <= 45000""",
    "raw_places_prepared": """
SELECT longitude, latitude, longitude - min(longitude) OVER () AS x, latitude - min(latitude) OVER () AS y
FROM (SELECT CAST(CAST(l_quantity * 1000 AS BIGINT) AS DOUBLE) AS longitude,
             CAST(CAST(floor(l_extendedprice) AS BIGINT) AS DOUBLE) AS latitude FROM lineitem) t""",
    "points_sink_roundtrip": """
SELECT p_partkey, p_brand, CAST(CAST(p_size * 1000 AS BIGINT) AS DOUBLE) AS x,
       CAST(CAST(round((p_retailprice - 900) * 500) AS BIGINT) AS DOUBLE) AS y FROM part""",
    "assignment_sink_roundtrip": S.with_recursive(
        S.PT, S.spread_init("pt", S.K_MIN, S.K_MAX), S.kmeans_rec("pt", "init"), S.kmeans_final()) + f"""
SELECT CAST(i.k AS INTEGER) AS k, p.x, p.y, {S.nearest('i.cs')}.x AS cx, {S.nearest('i.cs')}.y AS cy
FROM pt p, kmf i""",
    "wcss_sink_roundtrip": S.with_recursive(S.PT, S.kcenter_rec("pt", S.K_MAX)) + f"""
, cs AS (SELECT list({{'c': i, 'x': x, 'y': y}} ORDER BY i) AS l FROM kc)
SELECT CAST(g.k AS INTEGER) AS k, sum(list_min(list_transform(cs.l[1:g.k],
       lambda u: (p.x - u.x) * (p.x - u.x) + (p.y - u.y) * (p.y - u.y)))) AS wcss
FROM range({S.K_MIN}, {S.K_MAX + 1}) g(k), cs, pt p WHERE g.k <= len(cs.l) GROUP BY g.k""",
}
