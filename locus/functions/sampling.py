"""Seeded pseudo-random order of rows by key.

Rows are ordered by ``md5("<key>:<seed>")``, then by key.  It depends on the row's key only, never on
partitioning, and any engine with MD5 computes the same order.  The first k rows are a draw of k
distinct rows; draws for smaller k are prefixes of it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def seeded_rank(key: Column, seed: int) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{int(seed)}")).cast("binary"))
