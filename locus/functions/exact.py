"""Exact sums of doubles that don't depend on the order of the terms.

A term is cut into whole numbers of at most ``GRID`` bits on the grids ..., 2^-30, 2^0, 2^30, ...: the 53 bits of a
double touch at most three neighbouring ones.  Whole numbers of one grid (a *bin*) are added as integers, so
every bit of every term counts, whatever the magnitudes beside it and however rows are split over tasks.  A task adds
in int64 (it gives its sums out before 2^31 rows, and a row adds less than 2^30 to a bin), Spark adds the tasks' sums as
decimals of 38 digits, and the bins of a sum are put together and rounded once, at the end.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable
from fractions import Fraction

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID = 30
#: Rows after which a task gives its sums out.
MAX_ROWS = 1 << 31
#: Rows whose whole numbers are added in doubles (exact below 2^53).
CHUNK = 1 << 22


def cut(terms: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(top, parts): terms = sum of parts[i] * 2^(GRID (top - i)), parts whole numbers below 2^GRID in size."""
    top = (np.frexp(terms)[1].astype(np.int64) - 1) // GRID
    rest = np.ldexp(terms, (-GRID * top).astype(np.int32))
    parts = []
    for _ in range(2):
        part = np.trunc(rest)
        parts.append(part)
        rest = (rest - part) * float(1 << GRID)
    # What is left is a whole number: the lowest of 53 bits lies at most 60 places below the first grid.
    return top, [*parts, rest]


def dense(terms: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(bins, parts): a column of whole numbers (as doubles) for each bin that any term touches."""
    if not len(terms):
        return [], np.zeros((0, 0))
    top, parts = cut(terms)
    low = int(top.min()) - 2
    out = np.zeros((len(terms), int(top.max()) - low + 1))
    at = np.arange(len(terms))
    for i, part in enumerate(parts):
        out[at, top - i - low] = part
    used = np.flatnonzero(out.any(axis=0))
    return [low + int(b) for b in used], out[:, used]


class Sums:
    """Exact sums of one or more slots, as whole numbers by bin."""

    def __init__(self, slots: int):
        self.slots = slots
        self.bins: dict[int, np.ndarray] = {}

    def add_whole(self, b: int, slot: np.ndarray, whole: np.ndarray) -> None:
        """Add whole numbers of bin ``b`` (doubles whose sum is below 2^53, or integers) to their slots."""
        have = self.bins.get(b)
        if have is None:
            have = self.bins[b] = np.zeros(self.slots, np.int64)
        if whole.dtype.kind == "f":
            have += np.bincount(slot, weights=whole, minlength=self.slots).astype(np.int64)
        else:
            np.add.at(have, slot, whole)

    def add(self, slot: np.ndarray, terms: np.ndarray) -> None:
        for lo in range(0, len(terms), CHUNK):
            some = slot[lo:lo + CHUNK]
            bins, parts = dense(terms[lo:lo + CHUNK])
            for i, b in enumerate(bins):
                self.add_whole(b, some, parts[:, i])

    def rows(self) -> Iterable[tuple[int, np.ndarray, np.ndarray]]:
        """(bin, slots, sums) without zeros."""
        for b, sums in self.bins.items():
            has = np.flatnonzero(sums)
            if len(has):
                yield b, has, sums[has]


def scaled(bins: Iterable[tuple[int, int]]) -> tuple[int, int]:
    """(n, low): the exact value of (bin, sum) pairs is n * 2^(GRID low)."""
    bins = list(bins)
    low = min((b for b, _ in bins), default=0)
    return sum(int(n) << GRID * (b - low) for b, n in bins), low


def total(bins: Iterable[tuple[int, int]]) -> Fraction:
    n, low = scaled(bins)
    return Fraction(n << GRID * low) if low >= 0 else Fraction(n, 1 << -GRID * low)


def ratio(a: tuple[int, int], b: tuple[int, int] = (1, 0)) -> float:
    """The double nearest to a / b (both as ``scaled`` gives them); beyond the largest one, infinity."""
    (n, low), (m, base) = a, b
    shift = GRID * (low - base)
    n, m = (n << shift, m) if shift >= 0 else (n, m << -shift)
    try:
        # Python divides whole numbers of any size with one rounding.
        return n / m
    except OverflowError:
        return float("inf") if (n > 0) == (m > 0) else float("-inf")


def summed(c: str) -> Column:
    """Sum of the tasks' integers: decimals before they are added, so no count of rows makes it overflow."""
    return F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
