"""Dense, ordered row ids without a global window.

``row_number() OVER (ORDER BY ...)`` with no partition moves every row into
one task.  Instead: range-partition on the order key, sort inside each
partition, tag rows with ``monotonically_increasing_id`` (partition index in
the high bits, position in the low 33 bits), write that once to the shared
folder so the tags are fixed, count rows per partition (one row per
partition comes back), and add each partition's offset.  The offsets form a
table of one row per partition - bounded by the partition count, not the
data - joined back by broadcast.

The order key must be unique (e.g. distinct points ordered by ``x, y``), so
the result does not depend on the partitioning.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from locus.runtime import materialize, shuffle_partitions

_LOW_BITS = (1 << 33) - 1


def with_sequential_id(
    df: DataFrame,
    order_cols: list[str],
    id_col: str = "point_id",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = 1, 2, ... in ascending order of ``order_cols``."""
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    tagged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    tagged = materialize(tagged, "ids")
    part = F.shiftrightunsigned(F.col("_mid"), 33)
    # One row per partition: bounded by the partition count, not the data.
    counts = (
        tagged.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    )
    starts = [0, *accumulate(r["count"] for r in counts)][:-1]
    if not counts:
        return tagged.drop("_mid").withColumn(id_col, F.lit(None).cast("bigint"))
    offsets = spark.createDataFrame(
        [(int(r["_part"]), int(s)) for r, s in zip(counts, starts)],
        "_part BIGINT, _start BIGINT",
    )
    return (
        tagged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(
            id_col,
            (F.col("_start") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)) + 1).cast("bigint"),
        )
        .drop("_mid", "_part", "_start")
    )
