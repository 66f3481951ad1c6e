"""Distance expressions.

All are built-in column expressions, so they run inside whole-stage codegen.
Squared distance is written ``dx*dx + dy*dy`` (never ``pow``): with integer
coordinates it is exact, and it is the same arithmetic a SQL engine does.
Centres are small lists held as literals: the plan does not grow with the
data, and the driver ships at most ``k`` pairs of numbers per job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

Center = tuple[int, float, float]  # (center_id, cx, cy)


def sq_dist(x: Column, y: Column, cx, cy) -> Column:
    """Squared Euclidean distance; ``cx``/``cy`` may be columns or numbers."""
    cx = cx if isinstance(cx, Column) else F.lit(float(cx))
    cy = cy if isinstance(cy, Column) else F.lit(float(cy))
    dx = x - cx
    dy = y - cy
    return dx * dx + dy * dy


def dist(x: Column, y: Column, cx, cy) -> Column:
    """Euclidean distance ``sqrt(dx*dx + dy*dy)``."""
    return F.sqrt(sq_dist(x, y, cx, cy))


def nearest(x: Column, y: Column, centers: Sequence[Center], coords: bool = False) -> Column:
    """struct(d2, center_id[, cx, cy]) of the nearest centre; ties go to the lowest id.

    ``least`` over structs compares ``d2`` first, then ``center_id`` (unique,
    so the coordinates never decide).
    """
    if not centers:
        raise ValueError("nearest() needs at least one centre")

    def term(cid, cx, cy):
        fields = [sq_dist(x, y, cx, cy).alias("d2"), F.lit(int(cid)).alias("center_id")]
        if coords:
            fields += [F.lit(float(cx)).alias("cx"), F.lit(float(cy)).alias("cy")]
        return F.struct(*fields)

    terms = [term(cid, cx, cy) for cid, cx, cy in centers]
    return terms[0] if len(terms) == 1 else F.least(*terms)

