"""WCSS (P11, A4) for many k in one job, and the choice of k.

``wcss_curve``: one scan; each task sums, per k, the squared distance of its
points to their nearest centre, and the partial sums are added up.
``prefix_curve``: the same for prefix-nested centre lists (K-Center), where
the nearest-centre distance for k+1 is ``min(previous, new)``, so the kMax
distances are computed once and every k is a running minimum.

``best_k`` keeps the reference's rule: d_i = wcss[i+1] - wcss[i]; the best k
is the one after the first largest difference (the smallest drop).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from locus.functions.centers import prefix_sums, wcss_sums
from locus.functions.distance import Center


def wcss_curve(points: DataFrame, centers_by_k: Mapping[int, Sequence[Center]],
               x: str = "x", y: str = "y", weight: str | None = None) -> DataFrame:
    """(k, wcss) for arbitrary centre sets, all k in one scan."""
    return wcss_sums(points, centers_by_k, x, y, weight).select("k", "wcss")


def prefix_curve(points: DataFrame, centers: Sequence[Center], k_min: int, k_max: int,
                 x: str = "x", y: str = "y", weight: str | None = None) -> DataFrame:
    """(k, wcss, radius) for prefixes k_min..k_max of one ordered centre list."""
    k_max = min(k_max, len(centers))
    ks = list(range(k_min, k_max + 1))
    if not ks:
        return points.sparkSession.createDataFrame([], "k INT, wcss DOUBLE, radius DOUBLE")
    return (prefix_sums(points, centers, ks, x, y, weight)
            .select("k", "wcss", F.sqrt("max_d2").alias("radius")))


def with_diffs(curve: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Add ``diff`` = wcss(k) - wcss(previous k); the curve has one row per k."""
    w = Window.partitionBy(*group).orderBy("k") if group else Window.orderBy("k")
    return curve.withColumn("diff", F.col("wcss") - F.lag("wcss").over(w))


def best_k(curve: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """The k after the first maximum difference, per ``group``.

    The curve has at most kMax - kMin + 1 rows per group.
    """
    d = with_diffs(curve, group).filter(F.col("diff").isNotNull())
    agg = F.max_by(F.col("k"), F.struct(F.col("diff"), -F.col("k"))).alias("best_k")
    return d.groupBy(*group).agg(agg) if group else d.agg(agg)
