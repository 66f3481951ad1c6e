"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Rows that a Python stage hands back to Spark at once.
ROWS_OUT = 2000


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) only, so that no other column can clash; a null text is empty."""
    return docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def hex_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, as lowercase hex."""
    return F.sha2(utf8(text), 256)


def map_rows(df: DataFrame, rows: Callable[[tuple], Iterator[tuple]], schema: str,
             start: Callable[[], None] | None = None) -> DataFrame:
    """Apply ``rows`` (a row's values in, any number of rows out) in Arrow batches.

    Memory is bounded by one input batch and ``ROWS_OUT`` output rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        out: list[tuple] = []

        def flush():
            cols = list(zip(*out)) if out else [()] * len(fields)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(cols, fields)], schema=fields)
            out.clear()
            return batch

        for batch in batches:
            cols = batch.columns
            for i in range(batch.num_rows):
                out.extend(rows(tuple(c[i].as_py() for c in cols)))
                if len(out) >= ROWS_OUT:
                    yield flush()
        if out:
            yield flush()
        # Workers are used again: what this task's batches took goes back.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, keys: list[str], group: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """Apply ``group`` to the rows of each value of ``keys``, many groups to a task.

    A task holds one Arrow batch and one group at a time, so groups must be bounded.
    """
    def run(batches):
        rest: pa.Table | None = None

        def done(table: pa.Table, last: bool) -> tuple[list[pa.Table], pa.Table]:
            n = table.num_rows
            new = [False] * max(n - 1, 0)
            if n > 1:
                import numpy as np
                new = np.zeros(n - 1, bool)
                for k in keys:
                    col = table[k].to_numpy()
                    new |= col[1:] != col[:-1]
                new = np.flatnonzero(new) + 1
            starts = [0, *(int(i) for i in new)] if n > 1 else [0] * min(n, 1)
            ends = [*starts[1:], n]
            outs = [group(table.slice(a, b - a)) for a, b in zip(starts, ends) if last or b < n]
            return [x for x in outs if x is not None], table if last or not starts else table.slice(starts[-1])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None and rest.num_rows else table
            outs, rest = done(table, False)
            if outs:
                yield from pa.concat_tables(outs).to_batches()
        if rest is not None and rest.num_rows:
            outs, _ = done(rest, True)
            if outs:
                yield from pa.concat_tables(outs).to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
