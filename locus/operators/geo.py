"""Geographic preparation: origin shift (P7, P8, A6), polygon rows (J4, J5),
point in polygon (J3), region tagging (J6, A7) and region union (U1).

Point in polygon, at scale:

1. candidates - the grid has levels with cells 2^l wide; each province's bounding box stands on the level of its own
   size, in at most four cells, so one province a thousand times the others costs no more rows; a point
   probes one cell of each level that has a box; equi-join on
   the cell plus the bbox test gives (point, province) pairs;
2. crossings - polygon edges (hole rings included) are spread over
   horizontal bands, as many as the province's edges call for; each candidate meets the edges of its province in its
   own band, one array per (province, band), and counts those that a ray to
   +x crosses, with the half-open rule ``(y1 > py) <> (y2 > py)``;
3. inside = an odd count and not on any edge (``contains`` excludes the
   boundary).

The side of an edge on which a point lies is the sign of a determinant.  Its value in doubles has a known error bound: beyond the bound
the sign is certain, as it is for whole numbers below 2^53.  A point with an edge whose sign is in doubt (it lies on the edge, or within rounding of
it) is decided anew with fractions, which are exact for any doubles; such points are few and only they leave the JVM.
Points are never shuffled by province or cell while the shapes fit a byte-checked broadcast; past it
both joins are salted.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from locus.operators.joins import checked_broadcast, join_small
from locus.runtime import materialize

# Task closures call this module's functions; see functions.centers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Edges of a province for each of its bands.
EDGES_PER_BAND = 16
#: Of the sum of the two products' sizes: more than the rounding of their difference; and the size below which products may underflow.
ORIENTATION_ERROR, UNDERFLOW = 3.3306690738754716e-16, 1e-290


# ------------------------------------------------------------- origin shift

def origin_shift(points: DataFrame, lon: str = "longitude", lat: str = "latitude",
                 group: Sequence[str] = ()) -> DataFrame:
    """x = lon - min(lon), y = lat - min(lat), over all rows or per group.

    The minimum is a partial/final aggregate (skew-safe).  Over all rows it is
    one row, read back and applied as two literals; per group it is joined
    back, broadcast only after its size is checked.
    """
    mins = points.groupBy(*group).agg(F.min(lon).alias("_min_lon"), F.min(lat).alias("_min_lat"))
    if group:
        joined = join_small(points, mins, list(group))
    else:
        m = mins.first()
        joined = points.withColumns({"_min_lon": F.lit(m["_min_lon"]), "_min_lat": F.lit(m["_min_lat"])})
    return (joined.withColumn("x", F.col(lon) - F.col("_min_lon"))
            .withColumn("y", F.col(lat) - F.col("_min_lat"))
            .drop("_min_lon", "_min_lat"))


# ------------------------------------------------------------- polygon rows

def first_per_province(regions: DataFrame) -> DataFrame:
    """The first feature (by ``feature_order``) of every province name."""
    return (regions.groupBy("prov_name")
            .agg(F.min_by(F.struct("feature_id", "reg_name", "geometry"), F.col("feature_order")).alias("f"))
            .select("prov_name", "f.feature_id", "f.reg_name", "f.geometry"))


def vertices(regions: DataFrame) -> DataFrame:
    """(prov_name, reg_name, feature_id, poly_id, ring_id, seq, lon, lat); ids 1-based."""
    return (regions
            .select("prov_name", "reg_name", "feature_id", F.posexplode("geometry").alias("p0", "poly"))
            .select("*", F.posexplode("poly").alias("r0", "ring"))
            .select("*", F.posexplode("ring").alias("s0", "v"))
            .select("prov_name", "reg_name", "feature_id",
                    (F.col("p0") + 1).cast("int").alias("poly_id"),
                    (F.col("r0") + 1).cast("int").alias("ring_id"),
                    (F.col("s0") + 1).cast("int").alias("seq"),
                    F.col("v")[0].alias("lon"), F.col("v")[1].alias("lat")))


def edges(regions: DataFrame) -> DataFrame:
    """(prov_name, x1, y1, x2, y2): consecutive vertices of every closed ring."""
    rings = (regions.select("prov_name", F.explode("geometry").alias("poly"))
             .select("prov_name", F.explode("poly").alias("ring"))
             .filter(F.size("ring") >= 2))
    n = F.size("ring")
    pairs = F.arrays_zip(F.slice("ring", 1, n - 1).alias("a"), F.slice("ring", 2, n - 1).alias("b"))
    return (rings.select("prov_name", F.explode(pairs).alias("e"))
            .select("prov_name", F.col("e.a")[0].alias("x1"), F.col("e.a")[1].alias("y1"),
                    F.col("e.b")[0].alias("x2"), F.col("e.b")[1].alias("y2")))


# --------------------------------------------------------- point in polygon

def _products(px: Column, py: Column, edge: Column) -> tuple[Column, Column]:
    x1, y1, x2, y2 = (edge[c] for c in ("x1", "y1", "x2", "y2"))
    return (x2 - x1) * (py - y1), (y2 - y1) * (px - x1)


def _straddles(py: Column, edge: Column) -> Column:
    return (edge["y1"] > py) != (edge["y2"] > py)


def _beside(px: Column, py: Column, edge: Column) -> Column:
    x1, y1, x2, y2 = (edge[c] for c in ("x1", "y1", "x2", "y2"))
    return (px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2)) & (py >= F.least(y1, y2)) & (py <= F.greatest(y1, y2))


def _crossing(px: Column, py: Column, edge: Column) -> Column:
    a, b = _products(px, py, edge)
    return _straddles(py, edge) & F.when(edge["y2"] > edge["y1"], a > b).otherwise(a < b)


def _on_edge(px: Column, py: Column, edge: Column) -> Column:
    a, b = _products(px, py, edge)
    return (a == b) & _beside(px, py, edge)


def _in_doubt(px: Column, py: Column, edge: Column) -> Column:
    """Whether the sign of the edge's determinant matters and the doubles don't tell it for certain."""
    a, b = _products(px, py, edge)
    size = F.abs(a) + F.abs(b)
    zero = ((edge["x1"] == edge["x2"]) | (py == edge["y1"])) & ((edge["y1"] == edge["y2"]) | (px == edge["x1"]))
    whole = size < float(1 << 53)
    for c in (px, py, *(edge[c] for c in ("x1", "y1", "x2", "y2"))):
        whole = whole & (c == F.rint(c))
    close = (F.abs(a - b) <= size * ORIENTATION_ERROR) | (size < UNDERFLOW)
    return (_straddles(py, edge) | _beside(px, py, edge)) & close & ~whole & ~zero


def strictly_inside(px: float, py: float, edges: Sequence[tuple[float, float, float, float]]) -> bool:
    """The same test in exact arithmetic."""
    px, py = Fraction(px), Fraction(py)
    odd = False
    for x1, y1, x2, y2 in (map(Fraction, e) for e in edges):
        side = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
        if side == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
            return False
        if (y1 > py) != (y2 > py) and (side > 0 if y2 > y1 else side < 0):
            odd = not odd
    return odd


def _exactly(batches):
    for batch in batches:
        px, py, es = (batch.column(c).to_pylist() for c in ("px", "py", "es"))
        keep = [strictly_inside(x, y, [(e["x1"], e["y1"], e["x2"], e["y2"]) for e in edge]) for x, y, edge in zip(px, py, es)]
        yield batch.filter(pa.array(keep, pa.bool_()))


def box_cells(bbox: DataFrame) -> DataFrame:
    """``bbox`` once for each grid cell it touches on the level of its size: (*, level, cx, cy), at most four rows a box."""
    extent = F.greatest(F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0"))
    # 2^level is more than the extent, whatever the rounding; boxes without one stand on level 0.
    level = F.when(extent > 0, F.ceil(F.log2(extent) + 1e-9)).otherwise(0).cast("int")
    side = F.pow(F.lit(2.0), F.col("level"))
    spread = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / side), F.floor(F.col(hi) / side)))
    return bbox.withColumn("level", level).withColumn("cx", spread("bx0", "bx1")).withColumn("cy", spread("by0", "by1"))


def points_in_polygons(points: DataFrame, regions: DataFrame, id_col: str = "point_id",
                       lon: str = "lon", lat: str = "lat", carry: Sequence[str] = ()) -> DataFrame:
    """(prov_name, point id, *carry) for every point strictly inside a province.

    ``regions`` holds one geometry per province (after ``first_per_province``); ``carry`` names
    columns of ``regions`` to keep.  With ``carry`` the coordinates come along too.
    """
    e = materialize(edges(regions), "geo-edges")
    bbox = e.groupBy("prov_name").agg(
        F.least(F.min("x1"), F.min("x2")).alias("bx0"), F.greatest(F.max("x1"), F.max("x2")).alias("bx1"),
        F.least(F.min("y1"), F.min("y2")).alias("by0"), F.greatest(F.max("y1"), F.max("y2")).alias("by1"),
        F.ceil(F.count("*") / EDGES_PER_BAND).alias("n_bands"))
    height = (F.col("by1") - F.col("by0")) / F.col("n_bands")
    bbox = bbox.withColumn("band_height", F.when(height > 0, height).otherwise(1.0)).drop("n_bands")
    if carry:
        bbox = bbox.join(regions.select("prov_name", *carry), "prov_name")
    out = [F.col("pid").alias(id_col), *carry, *([F.col("px").alias(lon), F.col("py").alias(lat)] if carry else [])]
    # One row a province, written once: the grid cells, the levels and the bands are made from it.
    bbox = materialize(bbox, "geo-boxes")
    boxes = box_cells(bbox)
    # One number for each power of two among the boxes' sizes.
    levels = sorted(r["level"] for r in boxes.select("level").distinct().collect())
    band = lambda y: F.floor((F.col(y) - F.col("by0")) / F.col("band_height"))
    pts = points.select(F.col(id_col).alias("pid"), F.col(lon).alias("px"), F.col(lat).alias("py"))
    cells = F.array(*[F.struct(F.lit(n).alias("level"), F.floor(F.col("px") / 2.0 ** n).alias("cx"), F.floor(F.col("py") / 2.0 ** n).alias("cy"))
                      for n in levels or [0]])
    # Boxes and edges are copied to the points while they are small (measured in bytes), so no
    # point is moved; past that their keys are salted over SALTS and the points dealt among the copies.
    cand = (join_salted(pts.select("*", F.inline(cells)), boxes, ["level", "cx", "cy"], "pid")
            .filter((F.col("px") >= F.col("bx0")) & (F.col("px") <= F.col("bx1"))
                    & (F.col("py") >= F.col("by0")) & (F.col("py") <= F.col("by1")))
            .select("pid", "px", "py", "prov_name", *carry, band("py").alias("band")))
    # All edges of a point's band in its province as one array: the crossings are counted in the
    # row, so points are not grouped (and so not shuffled) again.
    banded = join_small(e, bbox.select("prov_name", "by0", "band_height"), "prov_name") \
        .withColumns({"low": F.least("y1", "y2"), "high": F.greatest("y1", "y2")})
    bands = materialize(banded.withColumn("band", F.explode(F.sequence(band("low"), band("high")))).groupBy("prov_name", "band").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("es")), "geo-bands")
    tested = join_salted(cand, bands, ["prov_name", "band"], "pid")
    px, py = F.col("px"), F.col("py")
    doubt = F.exists("es", lambda g: _in_doubt(px, py, g))
    inside = (F.size(F.filter("es", lambda g: _crossing(px, py, g))) % 2 == 1) & ~F.exists("es", lambda g: _on_edge(px, py, g))
    decided = materialize(
        tested.withColumn("doubt", doubt).filter(F.col("doubt") | inside)
        .select("prov_name", "pid", "px", "py", *carry, "doubt", F.when(F.col("doubt"), F.col("es")).alias("es")), "geo-decided")
    unsure = decided.filter("doubt")
    sure = decided.filter("NOT doubt").select("prov_name", *out)
    return sure.unionByName(unsure.mapInArrow(_exactly, unsure.schema).select("prov_name", *out))


SALTS = 16


def join_salted(points: DataFrame, small: DataFrame, on: list[str], key: str) -> DataFrame:
    """Inner join of many points with a table of shapes: a broadcast under the byte bound, else salted."""
    shapes = checked_broadcast(small)
    if shapes is not small:
        return points.join(shapes, on)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (points.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
            .join(salted, [*on, "_salt"]).drop("_salt"))


# ---------------------------------------------------------- regions

def region_provinces(regions: DataFrame) -> DataFrame:
    """Distinct (reg_name, prov_name)."""
    return regions.select("reg_name", "prov_name").distinct()


def region_points(points: DataFrame, regions: DataFrame, id_col: str = "point_id",
                  lon: str = "lon", lat: str = "lat") -> DataFrame:
    """J6 + P8: all provinces at once; each province's points shifted to the
    province's own origin.  (reg_name, prov_name, id, lon, lat, x, y)."""
    # Evaluated once: the minimum and the shift both read the written table.
    tagged = materialize(points_in_polygons(points, regions, id_col, lon, lat, carry=["reg_name"]), "geo-tagged")
    return origin_shift(tagged, lon, lat, ["prov_name"]).select(
        "reg_name", "prov_name", id_col, lon, lat, "x", "y")


def region_union(province_points: DataFrame, id_col: str = "point_id",
                 lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The union of a region's province sets (a point once per region),
    shifted to the region's origin.  (reg_name, id, lon, lat, x, y)."""
    pts = materialize(province_points.select("reg_name", id_col, lon, lat).dropDuplicates(["reg_name", id_col]),
                      "geo-union")
    return origin_shift(pts, lon, lat, ["reg_name"]).select("reg_name", id_col, lon, lat, "x", "y")
