"""Connected components of an undirected graph given as DataFrames (D3).

Alternating large-star and small-star contraction (Kiveris et al., 2014).
The state is a set of edges (a, b) with a > b.  With m(u) the least node
that u has an edge to (u itself if none):

* large star: every edge (a, b) becomes (a, m(b)): a hops over b;
* small star: every edge (a, b) becomes (b, m(a)), and (a, m(a)) is kept.

Both keep components unchanged and never add edges; repeated, they contract
every component to a star whose centre is its least node.  The loop stops when
a whole round changes nothing, which for a path of n nodes takes about log2 n
rounds.  There is no cap on rounds.

m is written before it is joined, so both join sides are plain scans:
a hub (a centre that a third of all edges point to) is a skewed partition that
adaptive execution can split.  Every step is a table in the shared checkpoint
folder: a lost executor costs one step, not all; finished steps are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from locus.runtime import discard, materialize, scratch_path


def contract(edges: DataFrame, src: str = "src", dst: str = "dst") -> tuple[DataFrame, int]:
    """(stars, rounds): (a, b) for every node a with an edge that is not the
    least of its component; b is that least node.  ``rounds`` counts the
    rounds that changed an edge.
    """
    spark = edges.sparkSession

    def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, name)
        return materialize(df, name, path), path

    x, y = F.col(src), F.col(dst)
    e, e_path = written(edges.filter(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(),
                        "cc-edges")
    if e.isEmpty():
        return e, 0
    rounds = 0
    while True:
        moved, folded = Observation(), Observation()
        low, low_path = written(e.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "cc-low")
        large, large_path = written(
            e.join(low, e["b"] == low["u"], "left")
            .observe(moved, F.count("m").alias("n"))
            .select("a", F.coalesce("m", "b").alias("b")), "cc-large")
        least, least_path = written(
            large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "cc-low")
        hung = (large.join(least, large["a"] == least["u"])
                .filter(F.col("b") != F.col("m"))
                .observe(folded, F.count("*").alias("n"))
                .select(F.col("b").alias("a"), F.col("m").alias("b")))
        new, new_path = written(
            hung.union(least.select("u", "m")).distinct(), "cc-edges")
        discard(spark, e_path, low_path, large_path, least_path)
        e, e_path = new, new_path
        if not moved.get["n"] and not folded.get["n"]:
            return e, rounds
        rounds += 1


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node",
                         src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, label): label = least node id in the node's component.

    ``nodes`` has a column ``node`` (unique, orderable); ``edges`` has
    ``src``/``dst`` in either or both directions, all of them in ``nodes``.
    """
    stars, _ = contract(edges, src, dst)
    v = nodes.select(F.col(node).alias("v"))
    return (v.join(stars, v["v"] == stars["a"], "left")
            .select(F.col("v").alias(node), F.coalesce("b", "v").alias("label")))
