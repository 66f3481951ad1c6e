"""K-Center by farthest-first traversal.

Traversal with certified steps: one Spark job summarises the points per
cell of a fixed grid (GRID x GRID cells, whatever the data size): the cell's
point farthest from the current centres (lowest ``point_id`` on ties) and
the bounding box of its points.  The driver then takes further steps from
those summaries alone for as long as each pick is provably the global one
(per-cell upper bounds from the boxes); only when a pick is uncertain does
it run the next job.  The answer is exactly the one-job-per-step traversal,
in fewer jobs.  Rows to the driver per job: at most GRID^2, after an aggregate
by cell.

With one seeded first centre the traversal for kMax contains the traversal
for every smaller k as a prefix, so a whole sweep k = kMin..kMax costs the
traversal plus one job for all the WCSS sums (``elbow.prefix_curve``).
The traversal stops early when every point is already a centre (distance 0).
``farthest_point`` (A5) is the single step, one job.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from locus.functions.centers import cell_farthest_partials, farthest_candidates
from locus.functions.distance import Center
from locus.functions.sampling import seeded_rank


@dataclass
class Farthest:
    point_id: int
    x: float
    y: float
    d2: float


def farthest_point(points: DataFrame, centers: list[Center], id_col: str = "point_id",
                   x: str = "x", y: str = "y") -> Farthest | None:
    """A5: the point farthest from its nearest centre (lowest id on ties)."""
    row = (farthest_candidates(points, centers, id_col, x, y)
           .agg(F.max_by(F.struct("i", "x", "y", "d2"), F.struct(F.col("d2"), -F.col("i"))).alias("far"))
           .first()["far"])
    if row is None:
        return None
    return Farthest(int(row["i"]), float(row["x"]), float(row["y"]), float(row["d2"]))


def first_center(points: DataFrame, first_id: int | None = 1, seed: int | None = None,
                 id_col: str = "point_id", x: str = "x", y: str = "y") -> tuple[int, float, float] | None:
    """The starting point: a given id, or the seeded smallest hash."""
    if seed is not None:
        h = seeded_rank(F.col(id_col), seed)
        rows = points.select(id_col, x, y).orderBy(h, id_col).limit(1).collect()
    else:
        rows = points.filter(F.col(id_col) == first_id).select(id_col, x, y).limit(1).collect()
    if not rows:
        return None
    r = rows[0]
    return int(r[id_col]), float(r[x]), float(r[y])


@dataclass
class TraversalStep:
    rank: int          # 1-based position in the traversal (= center_id)
    point_id: int
    x: float
    y: float
    d2: float          # squared distance to the nearest earlier centre (0 for rank 1)


GRID = 128  # cells per side of the summary grid: at most GRID^2 rows per job


#: Part of the points beyond the grid's equal cells on each side of an axis, and the accuracy (1 / error) of the quantiles that bound them.
OUTER, ACCURACY = 0.002, 2000


def grid_edges(points: DataFrame, x: str, y: str) -> tuple[np.ndarray, np.ndarray]:
    """GRID - 1 edges of each axis: equal cells between two quantiles, and an open one beyond each.

    So far outliers stand in cells of their own and don't make the others coarse.  The edges only decide how many steps a
    job certifies, not which.
    """
    ends = points.agg(*[F.percentile_approx(c, [OUTER, 1 - OUTER], ACCURACY) for c in (x, y)]).first()
    return tuple(np.linspace(lo, hi, GRID - 1) for lo, hi in ends)


def cell_summaries(points: DataFrame, centers: list[Center], grid: tuple,
                   id_col: str = "point_id", x: str = "x", y: str = "y") -> dict[str, np.ndarray]:
    """One job: per grid cell, its farthest point from ``centers`` (lowest id
    on ties) and the box of its points, as numpy columns."""
    parts = cell_farthest_partials(points, centers, grid, id_col, x, y).groupBy("cell").agg(
        F.max_by(F.struct("i", "x", "y", "d2"), F.struct(F.col("d2"), -F.col("i"))).alias("t"),
        F.min("x0").alias("x0"), F.max("x1").alias("x1"),
        F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    # At most GRID^2 rows, via Arrow.
    got = parts.select("cell", "t.i", "t.x", "t.y", "t.d2", "x0", "x1", "y0", "y1").toArrow().sort_by("cell")
    return {c: got[c].to_numpy() for c in ("i", "x", "y", "d2", "x0", "x1", "y0", "y1")} if got.num_rows else {}


def _certified_steps(cells: dict[str, np.ndarray], base: list[Center], want: int) -> list[TraversalStep]:
    """Continue the traversal on the driver from per-cell summaries taken
    against ``base``, as long as each pick is provably the global one.

    For a cell, every point's distance to (base + new centres) is at most
    ub = min(rep's distance to base, farthest-corner distance to each new
    centre) - float-monotone, so it bounds the computed distances too.  A
    pick (value v, id i) is certain when every other cell either has ub < v,
    or has a representative that is provably its own maximum (unchanged by
    the new centres, and ub equal to it), so that the (distance, -id) order
    over representatives covers that cell; the picked cell's representative
    must itself be unchanged.
    """
    out: list[TraversalStep] = []
    ids, rx, ry, d2 = cells["i"], cells["x"], cells["y"], cells["d2"]
    x0, x1, y0, y1 = cells["x0"], cells["x1"], cells["y0"], cells["y1"]
    val = d2.copy()   # representative's exact distance to all centres so far
    ub = d2.copy()    # bound for every point of the cell
    while len(out) < want:
        j = int(np.lexsort((ids, -val))[0])           # max value, lowest id
        v = float(val[j])
        ok = (ub < v) | ((val == d2) & (d2 == ub))
        ok[j] = val[j] == d2[j]
        if not ok.all() or v <= 0.0:
            return out
        sx, sy = float(rx[j]), float(ry[j])
        out.append(TraversalStep(len(base) + len(out) + 1, int(ids[j]), sx, sy, v))
        dx, dy = rx - sx, ry - sy
        val = np.minimum(val, dx * dx + dy * dy)
        fx = np.maximum(x1 - sx, sx - x0)
        fy = np.maximum(y1 - sy, sy - y0)
        ub = np.minimum(ub, fx * fx + fy * fy)
    return out


def kcenter_traversal(points: DataFrame, k: int, first_id: int | None = 1,
                      seed: int | None = None, id_col: str = "point_id",
                      x: str = "x", y: str = "y") -> list[TraversalStep]:
    """Farthest-first traversal to ``k`` centres (fewer if points run out).

    Each Spark job summarises the points per grid cell (farthest point from
    the current centres, bounding box; ``grid_edges``); the driver then takes as many
    further steps as the summaries certify (``_certified_steps``) before the
    next job.  Exact: a step that cannot be certified is never guessed.
    """
    start = first_center(points, first_id, seed, id_col, x, y)
    if start is None:
        return []
    steps = [TraversalStep(1, start[0], start[1], start[2], 0.0)]
    if k <= 1:
        return steps
    grid = grid_edges(points, x, y)
    while len(steps) < k:
        base = [(s.rank, s.x, s.y) for s in steps]
        cells = cell_summaries(points, base, grid, id_col, x, y)
        if not cells:
            break
        more = _certified_steps(cells, base, k - len(steps))
        if not more:
            # Not even the first pick certified: cannot happen (the first
            # pick after a refresh is the exact maximum) unless every point
            # coincides with a centre.
            break
        steps.extend(more)
    return steps


def centers_of(steps: list[TraversalStep]) -> list[Center]:
    return [(s.rank, s.x, s.y) for s in steps]


TRAVERSAL_SCHEMA = T.StructType([
    T.StructField("center_id", T.IntegerType(), False),
    T.StructField("point_id", T.LongType(), False),
    T.StructField("x", T.DoubleType(), False),
    T.StructField("y", T.DoubleType(), False),
    T.StructField("d2", T.DoubleType(), False),
])


def traversal_frame(spark: SparkSession, steps: list[TraversalStep]) -> DataFrame:
    rows = [(s.rank, s.point_id, s.x, s.y, s.d2) for s in steps]
    return spark.createDataFrame(rows, TRAVERSAL_SCHEMA)
