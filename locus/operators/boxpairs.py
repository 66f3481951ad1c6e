"""Pairs of boxes, refined level by level until each is settled or small.

Points stand in cells (``gx``, ``gy``) of a side.  Level 0 boxes are the cells; a box of a level is cut into ``SUB`` x ``SUB`` boxes of the
next.  A box is known by its cell and its place (``sx``, ``sy``) in it, and has the bounding box and the number of its points.
Of a pair of boxes the first has columns gx, gy, sx, sy, na and ax0 ... ay1, the second ngx, ngy, nsx, nsy, nb and bx0 ... by1.

``verdict``: a pair is *in* when even its farthest corners are within eps (so every pair of points in it is), *out* when its nearest sides
are farther than eps, else *open*.  Bounds come from the points' own coordinates by the same float operations as the test of two points, and
rounding is monotone, so a verdict always agrees with the exact ``sqrt(dx*dx+dy*dy) <= eps`` test on the points inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SUB = 4
#: Beyond this level a box is 2^-48 of a cell wide: its pairs are then tested whatever their number.
MAX_LEVEL = 24
BOX = ("x0", "x1", "y0", "y1")
FIRST, SECOND = ("gx", "gy", "sx", "sy"), ("ngx", "ngy", "nsx", "nsy")


def verdict(a: str, b: str, eps: float) -> Column:
    """1: every pair within eps; -1: none; 0: open.  ``a``/``b`` are column
    prefixes of two boxes (a point is a box with x0 = x1, y0 = y1)."""
    c = lambda name: F.col(name)
    far_x = F.greatest(c(b + "x1") - c(a + "x0"), c(a + "x1") - c(b + "x0"))
    far_y = F.greatest(c(b + "y1") - c(a + "y0"), c(a + "y1") - c(b + "y0"))
    near_x = F.greatest(c(b + "x0") - c(a + "x1"), c(a + "x0") - c(b + "x1"), F.lit(0.0))
    near_y = F.greatest(c(b + "y0") - c(a + "y1"), c(a + "y0") - c(b + "y1"), F.lit(0.0))
    e = F.lit(float(eps))
    return (F.when(F.sqrt(far_x * far_x + far_y * far_y) <= e, F.lit(1))
            .when(F.sqrt(near_x * near_x + near_y * near_y) > e, F.lit(-1))
            .otherwise(F.lit(0)))


def placed(points: DataFrame, side: float, level: int) -> DataFrame:
    """``points`` with the place of their box of a level.  Halving a side is exact, so boxes of a level nest in those of the level above."""
    parts = SUB ** level

    def place(c: str, g: str) -> Column:
        at = F.floor((F.col(c) - F.col(g) * F.lit(side)) / F.lit(side / parts))
        return F.least(F.greatest(at, F.lit(0)), F.lit(parts - 1)).cast("bigint")

    return points.withColumns({"sx": place("x", "gx"), "sy": place("y", "gy")})


def boxes(points: DataFrame, side: float, level: int) -> DataFrame:
    """(gx, gy, sx, sy, n, x0, x1, y0, y1) of every box of a level that has points (partial and final aggregate)."""
    return placed(points, side, level).groupBy(*FIRST).agg(
        F.count("*").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))


def as_first(found: DataFrame) -> DataFrame:
    return found.withColumnsRenamed({"n": "na", **{k: "a" + k for k in BOX}})


def as_second(found: DataFrame) -> DataFrame:
    return found.withColumnsRenamed({"n": "nb", **dict(zip(FIRST, SECOND)), **{k: "b" + k for k in BOX}})


def refined(open_pairs: DataFrame, points: DataFrame, side: float, level: int, eps: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """The pairs of the boxes one level down of open pairs of ``level``, with their verdict ``v`` (0 or 1; pairs that are out are left out).

    Only points of cells that an open pair names are looked at.
    """
    cells = open_pairs.select("gx", "gy").union(open_pairs.select("ngx", "ngy")).distinct()
    below = boxes(points.select("x", "y", "gx", "gy").join(cells, ["gx", "gy"], "left_semi"), side, level + 1)
    up = {"sx": F.expr(f"sx div {SUB}"), "sy": F.expr(f"sy div {SUB}")}
    own = as_first(below).select("gx", "gy", up["sx"].alias("px"), up["sy"].alias("py"), "sx", "sy", "na", *["a" + k for k in BOX])
    other = as_second(below).select("ngx", "ngy", F.expr(f"nsx div {SUB}").alias("npx"), F.expr(f"nsy div {SUB}").alias("npy"),
                                    "nsx", "nsy", "nb", *["b" + k for k in BOX])
    parents = open_pairs.select(*keep, "gx", "gy", F.col("sx").alias("px"), F.col("sy").alias("py"),
                                "ngx", "ngy", F.col("nsx").alias("npx"), F.col("nsy").alias("npy"))
    return (parents.join(own, ["gx", "gy", "px", "py"]).join(other, ["ngx", "ngy", "npx", "npy"])
            .withColumn("v", verdict("a", "b", eps)).filter(F.col("v") >= 0).drop("px", "py", "npx", "npy"))
