"""Density clustering (D1-D8) and the eps-range self-join.

Grid: cells of side ``eps/sqrt(2)`` (shrunk by 1e-9), so two points of one
cell are always within eps of each other.  Consequences:

* a cell holding >= minPts points is all core, with no distance test;
* all core points of one cell are connected, so components (D3) run on
  *cells* - a graph whose degree is at most 24, whatever the density;
* distance tests are needed only across cells (24 neighbouring cells:
  offsets -2..2) and, for neighbour counts and border points, only for
  points in *sparse* cells (< minPts points), so a dense cell's work is linear
  in its size.

Every step is an equi-join on the cell key plus a residual ``sqrt(d2) <= eps``
filter (the reference's test), then partial/final aggregates.  No step
collects points; the only driver-side values are counts.

Closed form (SURVEY 2.6), with ``point_id`` = order of the input:

* core: at least minPts points within eps, itself included;
* seed of a core point: least core ``point_id`` of its component; clusters
  are numbered 1, 2, ... in ascending seed order;
* border: a non-core point with a core neighbour; s = least seed among its
  core neighbours.  Mode ``order`` (the reference's visiting order): it
  joins s only if s < its own id, else it is noise.  Mode ``canonical``: it
  always joins s.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from locus.operators import boxpairs as bp
from locus.operators.components import connected_components
from locus.operators.ids import with_sequential_id
from locus.operators.joins import join_small
from locus.runtime import materialize

# Task closures call this module's functions; see functions.centers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MODES = ("order", "canonical")


def cell_side(eps: float) -> float:
    return eps / math.sqrt(2.0) * (1.0 - 1e-9)


def offsets(eps: float, half: bool = False, include_self: bool = False) -> list[tuple[int, int]]:
    """Cell offsets that can hold a point within eps of some point of cell (0, 0)."""
    s = cell_side(eps)
    r = int(math.ceil(eps / s))
    out = []
    for dx in range(-r, r + 1):
        for dy in range(-r, r + 1):
            if (dx, dy) == (0, 0) and not include_self:
                continue
            gx = max(0, abs(dx) - 1) * s
            gy = max(0, abs(dy) - 1) * s
            if gx * gx + gy * gy > eps * eps:
                continue
            if half and not (dx > 0 or (dx == 0 and dy > 0)):
                continue
            out.append((dx, dy))
    return out


def with_cells(points: DataFrame, eps: float, x: str = "x", y: str = "y") -> DataFrame:
    s = cell_side(eps)
    return (points.withColumn("gx", F.floor(F.col(x) / F.lit(s)).cast("long"))
            .withColumn("gy", F.floor(F.col(y) / F.lit(s)).cast("long")))


def _explode_offsets(df: DataFrame, offs: list[tuple[int, int]]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in offs])
    return (df.select("*", F.inline(arr))
            .withColumn("ngx", F.col("gx") + F.col("dx"))
            .withColumn("ngy", F.col("gy") + F.col("dy"))
            .drop("dx", "dy"))


def _within(eps: float) -> F.Column:
    dx = F.col("px") - F.col("qx")
    dy = F.col("py") - F.col("qy")
    return F.sqrt(dx * dx + dy * dy) <= F.lit(float(eps))


def _probe(points: DataFrame) -> DataFrame:
    return points.select(F.col("point_id").alias("pid"), F.col("x").alias("px"),
                         F.col("y").alias("py"), "gx", "gy")


def _target(points: DataFrame) -> DataFrame:
    return points.select(F.col("point_id").alias("qid"), F.col("x").alias("qx"),
                         F.col("y").alias("qy"), F.col("gx").alias("ngx"), F.col("gy").alias("ngy"))


def eps_neighbors(points: DataFrame, eps: float, id_col: str = "point_id",
                  x: str = "x", y: str = "y") -> DataFrame:
    """Every ordered pair (point_id, nbr_id) within eps, self included.

    Rows at one place are one point (their least id).

    The output is the neighbour relation itself, so its size is inherent;
    the plan is a cell equi-join (each point probes its own and the 24
    surrounding cells) with a residual distance filter.
    """
    pts = with_cells(points.groupBy(F.col(x).alias("x"), F.col(y).alias("y"))
                     .agg(F.min(id_col).alias("point_id")), eps)
    probe = _explode_offsets(_probe(pts), offsets(eps, include_self=True))
    pairs = probe.join(_target(pts), ["ngx", "ngy"]).filter(_within(eps))
    return pairs.select(F.col("pid").alias("point_id"), F.col("qid").alias("nbr_id"))


# ------------------------------------------------- the neighbour relation, compressed
#
# The relation of n points in one hot cell has n * n rows.  Written as pairs of boxes of which every pair of points is within eps
# (``blocks``) and the pairs that no block holds (``pairs``), the hot cell is one row.  Pairs of boxes are refined
# (``operators.boxpairs``) while they are open and hold more than PAIRS pairs; what is left is tested point by point.

PAIRS = 1024


@dataclass
class EpsRelation:
    """``points``: point_id, x, y, gx, gy; ``blocks``: level, gx, gy, sx, sy, ngx, ngy, nsx, nsy, na, nb;
    ``pairs``: point_id, nbr_id.  Both directions and every point's pair with itself are held."""

    points: DataFrame
    blocks: DataFrame
    pairs: DataFrame
    levels: list[int]
    side: float

    def expand(self) -> DataFrame:
        """(point_id, nbr_id): the relation itself."""
        out = self.pairs
        for level in self.levels:
            at = bp.placed(self.points, self.side, level).select("point_id", *bp.FIRST)
            out = out.unionByName(
                self.blocks.filter(F.col("level") == level).join(at, list(bp.FIRST))
                .join(at.withColumnsRenamed({"point_id": "nbr_id", **dict(zip(bp.FIRST, bp.SECOND))}), list(bp.SECOND))
                .select("point_id", "nbr_id"))
        return out

    def counts(self) -> DataFrame:
        """(point_id, n_neighbors), the point itself included: sums of the boxes' counts, no pair is made."""
        parts = self.pairs.groupBy("point_id").agg(F.count("*").alias("n"))
        for level in self.levels:
            per_box = self.blocks.filter(F.col("level") == level).groupBy(*bp.FIRST).agg(F.sum("nb").alias("n"))
            parts = parts.unionByName(
                join_small(bp.placed(self.points, self.side, level), per_box, list(bp.FIRST)).select("point_id", "n"))
        return parts.groupBy("point_id").agg(F.sum("n").alias("n_neighbors"))


def eps_relation(points: DataFrame, eps: float, id_col: str = "point_id", x: str = "x", y: str = "y") -> EpsRelation:
    """J2/D1 without its quadratic size.  Rows at one place are one point (their least id)."""
    side = cell_side(eps)
    pts = materialize(with_cells(points.groupBy(F.col(x).alias("x"), F.col(y).alias("y"))
                                 .agg(F.min(id_col).alias("point_id")), eps), "eps-points")
    cells = materialize(bp.boxes(pts, side, 0), "eps-cells")
    reach = _explode_offsets(bp.as_first(cells), offsets(eps, include_self=True))
    level = 0
    todo = materialize(
        reach.join(bp.as_second(cells), ["ngx", "ngy"]).withColumn("v", bp.verdict("a", "b", eps)).filter(F.col("v") >= 0), "eps-boxes")
    block_cols = [*bp.FIRST, *bp.SECOND, "na", "nb"]
    blocks, pairs, levels = [], [], []
    while True:
        levels.append(level)
        blocks.append(todo.filter(F.col("v") == 1).select(F.lit(level).alias("level"), *block_cols))
        open_pairs = todo.filter(F.col("v") == 0)
        is_large = (F.col("na") * F.col("nb") > PAIRS) & F.lit(level < bp.MAX_LEVEL)
        large, small = open_pairs.filter(is_large), open_pairs.filter(~is_large)
        at = bp.placed(pts, side, level)
        tested = (small.select(*bp.FIRST, *bp.SECOND)
                  .join(at.select(F.col("point_id").alias("pid"), F.col("x").alias("px"), F.col("y").alias("py"), *bp.FIRST), list(bp.FIRST))
                  .join(at.select(F.col("point_id").alias("qid"), F.col("x").alias("qx"), F.col("y").alias("qy"),
                                  *[F.col(a).alias(b) for a, b in zip(bp.FIRST, bp.SECOND)]), list(bp.SECOND)))
        pairs.append(tested.filter(_within(eps)).select(F.col("pid").alias("point_id"), F.col("qid").alias("nbr_id")))
        if large.isEmpty():
            break
        todo = materialize(bp.refined(large, pts, side, level, eps), "eps-boxes")
        level += 1
    all_of = lambda parts, name: materialize(reduce(DataFrame.unionByName, parts), name)
    return EpsRelation(pts, all_of(blocks, "eps-blocks"), all_of(pairs, "eps-pairs"), levels, side)


def neighbor_counts(points: DataFrame, eps: float, id_col: str = "point_id", x: str = "x", y: str = "y") -> DataFrame:
    """(point_id, n_neighbors) of every distinct place, itself included."""
    return eps_relation(points, eps, id_col, x, y).counts()


# ------------------------------------------------- links between core cells
#
# Two core cells are linked when some core point of one lies within eps of some core point of the other.  Testing every
# pair of points costs |A| x |B|, quadratic when dense cells sit side by side.  Instead boxes settle it, level by level
# (``operators.boxpairs``), and a pair of cells is done as soon as any pair of its boxes is in:
#
#   1. the boxes of neighbouring cells;
#   2. boxes one level down, and again for pairs that hold more than LINK_POINTS points;
#   3. the points of each side against the other side's box: those beyond eps of it drop out;
#   4. what is left of a pair of boxes - at most LINK_POINTS points - goes to one task, which halves the larger side at its
#      median until a pair is settled by its boxes or holds at most LINK_PAIRS pairs, nearest boxes first.

LINK_POINTS, LINK_PAIRS = 1 << 16, 4096


def nearest_within(a: np.ndarray, b: np.ndarray, eps: float, least: int = LINK_PAIRS) -> tuple[bool, int]:
    """Whether some row (x, y) of ``a`` lies within ``eps`` of one of ``b``, and the pairs of points tested."""
    tests = 0
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        (ax0, ay0), (ax1, ay1), (bx0, by0), (bx1, by1) = a.min(0), a.max(0), b.min(0), b.max(0)
        far = np.maximum(bx1 - ax0, ax1 - bx0), np.maximum(by1 - ay0, ay1 - by0)
        near = max(bx0 - ax1, ax0 - bx1, 0.0), max(by0 - ay1, ay0 - by1, 0.0)
        if np.sqrt(far[0] * far[0] + far[1] * far[1]) <= eps:
            return True, tests
        if np.sqrt(near[0] * near[0] + near[1] * near[1]) > eps:
            continue
        if len(a) * len(b) <= least:
            tests += len(a) * len(b)
            dx, dy = (np.subtract.outer(a[:, i], b[:, i]) for i in (0, 1))
            if (np.sqrt(dx * dx + dy * dy) <= eps).any():
                return True, tests
            continue
        if len(a) < len(b):
            a, b = b, a
        axis = int((a.max(0) - a.min(0)).argmax())
        order = np.argpartition(a[:, axis], len(a) // 2)
        halves = [(a[some], b) for some in (order[:len(a) // 2], order[len(a) // 2:])]
        # The half whose middle is nearer to the other side is looked at first.
        halves.sort(key=lambda h: -np.hypot(*(np.median(h[0], axis=0) - np.median(b, axis=0))))
        stack += halves
    return False, tests


def core_links(core_n: DataFrame, eps: float, stats: dict | None = None) -> DataFrame:
    """(src, dst) node pairs of neighbouring core cells that are linked; ``stats`` takes the pairs of points tested.

    ``core_n``: core points with ``point_id, x, y, gx, gy, node``.
    """
    side, ends = cell_side(eps), ("src", "dst")
    # 1. cells
    nodes = core_n.groupBy("gx", "gy").agg(F.first("node").alias("node"))
    cells = bp.boxes(core_n, side, 0).join(nodes, ["gx", "gy"])
    level = 0
    todo = materialize(
        _explode_offsets(bp.as_first(cells).withColumnRenamed("node", "src"), offsets(eps, half=True))
        .join(bp.as_second(cells).withColumnRenamed("node", "dst"), ["ngx", "ngy"])
        .withColumn("v", bp.verdict("a", "b", eps)).filter(F.col("v") >= 0), "db-cell-pairs")
    linked = [todo.filter(F.col("v") == 1).select(*ends)]
    open_pairs = todo.filter(F.col("v") == 0)
    # 2. boxes, level by level
    while level == 0 or level < bp.MAX_LEVEL and not open_pairs.filter(F.col("na") + F.col("nb") > LINK_POINTS).isEmpty():
        todo = materialize(bp.refined(open_pairs, core_n, side, level, eps, ends), "db-sub-pairs")
        level += 1
        linked.append(todo.filter(F.col("v") == 1).select(*ends).distinct())
        open_pairs = todo.filter(F.col("v") == 0).join(linked[-1], list(ends), "left_anti")
    # 3. points against boxes
    at = bp.placed(core_n, side, level).select("x", "y", *bp.FIRST)
    point = {"px0": F.col("x"), "px1": F.col("x"), "py0": F.col("y"), "py1": F.col("y")}
    key = [*ends, *bp.FIRST, *bp.SECOND]

    def near(box: str, own: tuple[str, ...]) -> DataFrame:
        """The points of one side that may lie within eps of the other side's box."""
        mine = at.withColumnsRenamed(dict(zip(bp.FIRST, own)))
        return (open_pairs.select(*key, *[box + k for k in bp.BOX]).join(mine, list(own)).withColumns(point)
                .withColumn("v", bp.verdict("p", box, eps)).filter(F.col("v") >= 0)
                .select(*key, F.lit(box == "b").alias("first"), "x", "y", "v"))

    points = materialize(near("b", bp.FIRST).unionByName(near("a", bp.SECOND)), "db-point-box")
    linked.append(points.filter(F.col("v") == 1).select(*ends).distinct())
    left = points.filter(F.col("v") == 0).join(linked[-1], list(ends), "left_anti").drop("v")

    # 4. bounded groups
    def test(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        xy, first = rows[["x", "y"]].to_numpy(np.float64), rows["first"].to_numpy(bool)
        found, tests = nearest_within(xy[first], xy[~first], eps) if first.any() and not first.all() else (False, 0)
        return pd.DataFrame({"src": [group[0]], "dst": [group[1]], "found": [found], "tests": [tests]})

    kind = core_n.schema["node"].dataType.simpleString()
    tested = materialize(left.groupBy(*key).applyInPandas(test, f"src {kind}, dst {kind}, found boolean, tests bigint"), "db-link-tests")
    if stats is not None:
        stats["tests"] = tested.agg(F.sum("tests")).first()[0] or 0
    linked.append(tested.filter("found").select(*ends))
    return reduce(DataFrame.unionByName, linked).distinct()


@dataclass
class DbscanParts:
    counts: DataFrame      # point_id, x, y, gx, gy, n_cell, core
    core: DataFrame        # point_id, seed
    border: DataFrame      # point_id, seed  (least seed among core neighbours)
    clusters: DataFrame    # seed, cluster_id


def dbscan_parts(points: DataFrame, eps: float, min_pts: int, id_col: str = "point_id",
                 x: str = "x", y: str = "y") -> DbscanParts:
    """Everything both border modes share.

    A neighbourhood is a set of coordinates, so rows at one place are one point, named by their
    least id; ``labels_of_rows`` gives every row its point's label.
    """
    pts = with_cells(points.groupBy(F.col(x).alias("x"), F.col(y).alias("y"))
                     .agg(F.min(id_col).alias("point_id")), eps)
    cell_n = pts.groupBy("gx", "gy").agg(F.count("*").alias("n_cell"))
    # Per-cell tables join back by a checked broadcast: a hot cell (a third of
    # the points) must not become one sort-merge key in one task.
    pts = materialize(join_small(pts, cell_n, ["gx", "gy"]), "db-points")

    # Cross-cell neighbours of points in sparse cells (dense cells need none).
    # A dense neighbour cell whose box lies wholly within eps of the point
    # counts in full, with no pair tests: next to a hot cell a sparse point
    # costs one row, not one row per point of the hot cell.
    sparse = pts.filter(F.col("n_cell") < min_pts)
    probe = _explode_offsets(_probe(sparse), offsets(eps))
    dense_cells = bp.as_second(bp.boxes(pts.filter(F.col("n_cell") >= min_pts), cell_side(eps), 0))
    dbox = dense_cells.select("ngx", "ngy", F.col("nb").alias("n_b"), *["b" + k for k in bp.BOX])
    pb = (join_small(probe, dbox, ["ngx", "ngy"], "left")
          .withColumns({"ax0": F.col("px"), "ax1": F.col("px"), "ay0": F.col("py"), "ay1": F.col("py")})
          # 1: the whole dense cell is within eps; -1: none of it; 0: test pairs.
          .withColumn("v", F.when(F.col("n_b").isNotNull(), bp.verdict("a", "b", eps)).otherwise(F.lit(0))))
    pb = materialize(pb.filter(F.col("v") >= 0).select("pid", "px", "py", "ngx", "ngy", "n_b", "v"),
                     "db-probes")
    tested = (pb.filter(F.col("v") == 0).select("pid", "px", "py", "ngx", "ngy", "n_b")
              .join(_target(pts), ["ngx", "ngy"]).filter(_within(eps)))
    # Sparse cells hold fewer than minPts points each: their pairs are listed.
    cand = materialize(tested.filter(F.col("n_b").isNull()).select("pid", "qid"), "db-sparse-pairs")
    # Of a partly covered dense cell only the number of points within eps is kept, summed before
    # anything moves: a hot cell gives one row per sparse point beside it.
    dense = materialize(tested.filter(F.col("n_b").isNotNull()).groupBy("pid", "ngx", "ngy")
                        .agg(F.count("*").alias("n")), "db-dense-counts")
    dense = dense.unionByName(pb.filter(F.col("v") == 1).select("pid", "ngx", "ngy", F.col("n_b").alias("n")))
    cross = (cand.groupBy("pid").agg(F.count("*").alias("n_cross"))
             .unionByName(dense.groupBy("pid").agg(F.sum("n").alias("n_cross")))
             .groupBy("pid").agg(F.sum("n_cross").alias("n_cross")))
    counts = (pts.join(cross, pts.point_id == cross.pid, "left")
              # Points of dense cells are core whatever stands across their cell.
              .withColumn("core", F.col("n_cell") + F.coalesce(F.col("n_cross"), F.lit(0)) >= F.lit(min_pts))
              .drop("pid", "n_cross"))
    counts = materialize(counts, "db-counts")
    core = counts.filter("core").select("point_id", "x", "y", "gx", "gy")

    # Core cells are graph nodes, named by their least core point id.
    cells = core.groupBy("gx", "gy").agg(F.min("point_id").alias("node"))
    core_n = join_small(core, cells, ["gx", "gy"])
    edges = core_links(core_n, eps)
    comp = connected_components(cells.select("node"), edges, "node", "src", "dst")
    core_seed = materialize(
        join_small(core_n, comp, "node").select("point_id", F.col("label").alias("seed")),
        "db-core")

    # Clusters numbered 1, 2, ... in ascending seed order.  No seed is ever
    # sampled from the unvisited points (J7): the least id of a component is
    # the seed the visiting order would reach first.
    seeds = core_seed.select("seed").distinct()
    clusters = with_sequential_id(seeds, ["seed"], "cluster_id")

    # D5 border candidates: non-core points (all in sparse cells) next to a core point,
    # in their own cell (always within eps) or across cells (tested pairs).
    noncore = counts.filter(~F.col("core")).select("point_id", "gx", "gy")
    sparse_core = counts.filter(F.col("core") & (F.col("n_cell") < F.lit(min_pts)))
    same_cell = (noncore.join(sparse_core.select("gx", "gy", F.col("point_id").alias("qid")), ["gx", "gy"])
                 .select("point_id", "qid"))
    cross_core = (cand.join(noncore.select(F.col("point_id").alias("pid")), "pid")
                  .select(F.col("pid").alias("point_id"), "qid"))
    via_points = (same_cell.unionByName(cross_core)
                  .join(core_seed.select(F.col("point_id").alias("qid"), "seed"), "qid")
                  .select("point_id", "seed"))
    # Dense cells with a point within eps: all core, one component, so one seed per cell.
    cell_seed = join_small(cells, comp, "node").select(
        F.col("gx").alias("ngx"), F.col("gy").alias("ngy"), F.col("label").alias("seed"))
    via_cells = (dense.join(noncore.select(F.col("point_id").alias("pid")), "pid")
                 .join(cell_seed, ["ngx", "ngy"])
                 .select(F.col("pid").alias("point_id"), "seed"))
    border = (via_points.unionByName(via_cells)
              .groupBy("point_id").agg(F.min("seed").alias("seed")))
    return DbscanParts(counts, core_seed, materialize(border, "db-border"), clusters)


def labels(parts: DbscanParts, mode: str = "order") -> DataFrame:
    """(point_id, cluster_id, role) for clustered points; noise left out."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    b = parts.border
    if mode == "order":
        b = b.filter(F.col("seed") < F.col("point_id"))
    core = parts.core.select("point_id", "seed", F.lit("core").alias("role"))
    border = b.select("point_id", "seed", F.lit("border").alias("role"))
    return (join_small(core.unionByName(border), parts.clusters, "seed")
            .select("point_id", F.col("cluster_id").cast("int").alias("cluster_id"), "role"))


def noise(parts: DbscanParts, mode: str = "order") -> DataFrame:
    """Points left without a cluster."""
    lab = labels(parts, mode).select("point_id")
    return parts.counts.select("point_id").join(lab, "point_id", "left_anti")


def labels_of_rows(points: DataFrame, parts: DbscanParts, mode: str = "order", id_col: str = "point_id",
                   x: str = "x", y: str = "y") -> DataFrame:
    """(id, cluster_id, role) for every row of ``points``; noise has no cluster.

    Joins on the place: rows at a place that very many share are a skewed partition
    of a plain scan, which adaptive execution splits.
    """
    named = materialize(parts.counts.select("x", "y", "point_id").join(labels(parts, mode), "point_id", "left")
                        .select("x", "y", "cluster_id", F.coalesce("role", F.lit("noise")).alias("role")), "db-places")
    return (points.select(F.col(id_col), F.col(x).alias("x"), F.col(y).alias("y")).join(named, ["x", "y"])
            .select(id_col, "cluster_id", "role"))


def dbscan(points: DataFrame, eps: float, min_pts: int, mode: str = "order",
           id_col: str = "point_id", x: str = "x", y: str = "y") -> DataFrame:
    """(point_id, cluster_id, role) - the whole operator."""
    return labels(dbscan_parts(points, eps, min_pts, id_col, x, y), mode)
