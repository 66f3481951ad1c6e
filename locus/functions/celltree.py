"""A summary tree of points for Lloyd rounds: whole cells are given to a centre, points are tested on boundaries only.

Built once, without a shuffle: every task cuts its own points into trees of at most ``TREE`` points.  A tree is a
balanced k-d order of its points (halved at the median of the wider side, so outliers cost nothing); every ``LEAF`` consecutive
points are a leaf, every ``FAN`` nodes of a level one node of the next.  A node holds its bounding box and the exact sums
(``functions.exact``) of x w, y w and w of its points.  A tree is one row of packed arrays.

A round goes down each tree with the centres of all k at once.  At a node, a centre is dropped from its set if
every point of the box is nearer to the set's centre next to the middle of the box: the difference of the two squared distances is linear
in the point, so one corner decides.  The margin covers the rounding of both distances, so a drop agrees with the
float comparison of every point inside, ties included.  If one centre is left, the node's sums are added
to it as a whole; else its children are looked at, and at a leaf the points are tested against the centres left.  Ties go to the
first centre of the set, as everywhere.  The sums are exact, so the result has the bits of testing every point.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from locus.functions import exact
from locus.functions.centers import Flat

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREE, LEAF, FAN = 1 << 18, 64, 4
#: Of the largest squared distance: more than the rounding of two of them (each is within 5 * 2^-53 of its value).
MARGIN = 2.0 ** -45
#: Pairs of a leaf and a centre whose points are tested together.
TESTED = 1 << 12

TREE_SCHEMA = "n int, xs binary, ys binary, ws binary, boxes binary, bins array<int>, sums binary"
_NAMES = ["n", "xs", "ys", "ws", "boxes", "bins", "sums"]


def level_sizes(n: int) -> list[int]:
    """Nodes of each level, leaves first; the last has one."""
    out = [-(-n // LEAF)]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def kd_order(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """An order in which every aligned run of LEAF, 2 LEAF, 4 LEAF ... points is a cell of a k-d tree."""
    n = len(xs)
    order = np.arange(n)
    size = LEAF
    while size < n:
        size *= 2
    while size > LEAF:
        starts = np.arange(0, n, size)
        x, y = xs[order], ys[order]
        spread = [np.maximum.reduceat(c, starts) - np.minimum.reduceat(c, starts) for c in (x, y)]
        cell = np.arange(n) // size
        order = order[np.lexsort((np.where((spread[0] >= spread[1])[cell], x, y), cell))]
        size //= 2
    return order


class Tree:
    def __init__(self, xs, ys, ws, boxes, bins, sums):
        self.xs, self.ys, self.ws = xs, ys, ws
        #: Over all levels, leaves first: (nodes, 4) boxes and (nodes, 3, bins) sums.
        self.boxes, self.bins, self.sums = boxes, bins, sums
        self.sizes = level_sizes(len(xs))

    @classmethod
    def of(cls, xs: np.ndarray, ys: np.ndarray, ws: np.ndarray) -> Tree:
        order = kd_order(xs, ys)
        xs, ys, ws = xs[order], ys[order], ws[order]
        bins, parts = exact.dense(np.concatenate([xs * ws, ys * ws, ws]))
        parts = parts.astype(np.int64).reshape(3, len(xs), len(bins)).transpose(1, 0, 2)
        starts = np.arange(0, len(xs), LEAF)
        box = np.column_stack([f.reduceat(c, starts) for c in (xs, ys) for f in (np.minimum, np.maximum)])
        sums = np.add.reduceat(parts, starts, axis=0)
        boxes, all_sums = [box], [sums]
        while len(box) > 1:
            starts = np.arange(0, len(box), FAN)
            box = np.column_stack([f.reduceat(box[:, i], starts) for i, f in enumerate((np.minimum, np.maximum) * 2)])
            sums = np.add.reduceat(sums, starts, axis=0)
            boxes.append(box)
            all_sums.append(sums)
        return cls(xs, ys, ws, np.concatenate(boxes), bins, np.concatenate(all_sums))

    def pack(self) -> list:
        return [len(self.xs), *[a.tobytes() for a in (self.xs, self.ys, self.ws, self.boxes)], self.bins, self.sums.tobytes()]

    @classmethod
    def unpack(cls, n, xs, ys, ws, boxes, bins, sums) -> Tree:
        f = lambda b: np.frombuffer(b.as_buffer(), np.float64)
        bins = bins.as_py()
        return cls(f(xs), f(ys), f(ws), f(boxes).reshape(-1, 4), bins,
                   np.frombuffer(sums.as_buffer(), np.int64).reshape(-1, 3, len(bins)))

    def assign(self, flat: Flat, into: list[exact.Sums]) -> int:
        """Add the points' sums of x w, y w and w to their centres; the tests made (of boxes and of points)."""
        tests = 0
        set_of = np.repeat(np.arange(len(flat.ks)), [b - a for a, b in flat.bounds])
        first = np.cumsum([0, *self.sizes])
        node, cen = np.zeros(flat.size, np.int64), np.arange(flat.size)
        for level in range(len(self.sizes) - 1, -1, -1):
            tests += len(node)
            node, cen, gid, alone = filtered(self.boxes[first[level]:], node, cen, set_of, flat)
            if alone.any():
                # One centre is left: the whole cell is its own.
                sums = self.sums[first[level] + node[alone]]
                for d, acc in enumerate(into):
                    for i, b in enumerate(self.bins):
                        acc.add_whole(b, cen[alone], sums[:, d, i].astype(np.float64) if abs(sums[:, d, i]).sum() < 1 << 53 else sums[:, d, i])
                node, cen = node[~alone], cen[~alone]
            if not len(node):
                return tests
            if level:
                kids = (node[:, None] * FAN + np.arange(FAN)).T.ravel()
                there = kids < self.sizes[level - 1]
                kids, again = kids[there], np.tile(cen, FAN)[there]
                order = np.argsort(kids, kind="stable")
                node, cen = kids[order], again[order]
        groups = np.flatnonzero(starts_of(node, set_of[cen]))
        # Whole groups at a time, so that memory is bounded.
        cuts = [0]
        for g in [*groups[1:].tolist(), len(node)]:
            if g - cuts[-1] >= TESTED or g == len(node):
                cuts.append(g)
        for a, b in zip(cuts, cuts[1:]):
            tests += self.test_leaves(node[a:b], cen[a:b], set_of, flat, into)
        return tests

    def test_leaves(self, leaf: np.ndarray, cen: np.ndarray, set_of: np.ndarray, flat: Flat, into: list[exact.Sums]) -> int:
        """Test the points of leaves against the centres left; pairs come sorted by leaf, then set, then centre."""
        n = len(self.xs)
        at = leaf[:, None] * LEAF + np.arange(LEAF)
        inside = at < n
        np.minimum(at, n - 1, out=at)
        d2 = flat.cx[cen][:, None] - self.xs[at]
        d2 *= d2
        dy = flat.cy[cen][:, None] - self.ys[at]
        dy *= dy
        d2 += dy
        new = starts_of(leaf, set_of[cen])
        starts = np.flatnonzero(new)
        gid = np.cumsum(new) - 1
        least = np.minimum.reduceat(d2, starts, axis=0)
        owner = np.empty((len(starts), LEAF), np.int64)
        rank = np.arange(len(leaf)) - starts[gid]
        for r in range(int(rank.max()), -1, -1):
            # From the last centre of each set to the first, so that the first of equals stays.
            some = np.flatnonzero(rank == r)
            hit = d2[some] == least[gid[some]]
            g = gid[some]
            owner[g] = np.where(hit, cen[some][:, None], owner[g])
        points, here = at[starts], inside[starts]
        slot, points = owner[here], points[here]
        w = self.ws[points]
        for acc, terms in zip(into, (self.xs[points] * w, self.ys[points] * w, w)):
            acc.add(slot, terms)
        return int(inside.sum())


def starts_of(node: np.ndarray, kind: np.ndarray) -> np.ndarray:
    out = np.ones(len(node), bool)
    out[1:] = (node[1:] != node[:-1]) | (kind[1:] != kind[:-1])
    return out


def filtered(boxes: np.ndarray, node: np.ndarray, cen: np.ndarray, set_of: np.ndarray, flat: Flat):
    """The pairs (node, centre) in which the centre may own a point of the node, their groups (node, set), and which are alone in theirs."""
    new = starts_of(node, set_of[cen])
    starts, gid = np.flatnonzero(new), np.cumsum(new) - 1
    x0, x1, y0, y1 = boxes[node].T
    cx, cy = flat.cx[cen], flat.cy[cen]
    mid = (cx - (x0 + x1) / 2) ** 2 + (cy - (y0 + y1) / 2) ** 2
    near = np.flatnonzero(mid == np.minimum.reduceat(mid, starts)[gid])
    best = np.empty(len(starts), np.int64)
    best[gid[near][::-1]] = near[::-1]
    best = best[gid]
    bx, by = cx[best], cy[best]
    # The corner at which this centre gains most on the best one.
    vx, vy = np.where(cx > bx, x1, x0), np.where(cy > by, y1, y0)
    own, other = (vx - cx) ** 2 + (vy - cy) ** 2, (vx - bx) ** 2 + (vy - by) ** 2
    most = 2 * (own + other) + 4 * ((x1 - x0) ** 2 + (y1 - y0) ** 2)
    keep = ~(own - other > MARGIN * most)
    keep[best] = True
    gid = gid[keep]
    alone = np.bincount(gid, minlength=len(starts))[gid] == 1
    return node[keep], cen[keep], gid, alone


# ----------------------------------------------------- Spark

def build(points: DataFrame, x: str = "x", y: str = "y", weight: str | None = None) -> DataFrame:
    """A row for each tree; points don't leave their partition."""
    cols = [x, y] + ([weight] if weight else [])

    def packed(batches):
        held: list[list[np.ndarray]] = []
        size = 0

        def flush():
            tree = Tree.of(*(np.concatenate(c) for c in zip(*held)))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(tree.pack(), [pa.int32(), *[pa.binary()] * 4, pa.list_(pa.int32()), pa.binary()])], _NAMES)

        for batch in batches:
            got = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for c in cols]
            if not weight:
                got.append(np.ones(batch.num_rows))
            while len(got[0]):
                take = TREE - size
                held.append([c[:take] for c in got])
                size += len(held[-1][0])
                got = [c[take:] for c in got]
                if size == TREE:
                    yield flush()
                    held.clear()
                    size = 0
        if size:
            yield flush()

    return points.select(*cols).mapInArrow(packed, TREE_SCHEMA)
