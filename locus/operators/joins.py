"""Joins against a side that is small only if we check it.

``broadcast()`` is used only after measuring the small side (one job, which
stops at the bound) and only under a bound in bytes.  Past it the join is left to the
planner: a shuffle join, which adaptive execution may still turn into a broadcast from
its own statistics or split on skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Bytes we are willing to copy to every executor, and the least that a row takes there.
BROADCAST_MAX_BYTES = 32 << 20
ROW_BYTES = 32


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: 8 for a number, the real length of strings, the text form of nested columns."""
    out = F.lit(ROW_BYTES)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            out = out + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out = out + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
        else:
            out = out + F.lit(8)
    return out


def checked_broadcast(small: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(small)`` if it takes at most ``max_bytes``, else ``small``."""
    size = (small.limit(max_bytes // ROW_BYTES + 1).select(row_bytes(small).cast("bigint").alias("b"))
            .agg(F.sum("b")).first()[0])
    return F.broadcast(small) if (size or 0) <= max_bytes else small


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str] | Column,
    how: str = "inner",
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    return big.join(checked_broadcast(small, max_bytes), on, how)
