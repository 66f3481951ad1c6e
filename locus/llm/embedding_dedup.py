"""Embedding near-duplicates by NN-descent.

Nodes are distinct unit vectors.  First, tight groups are folded: in blocks of vectors with the same signs on
random hyperplanes, each vector joins a leader whose class stays within half of the link angle, so by the
triangle inequality all members of a class are linked with each other and no pair of them need
be listed.  Blocks of a common sign code are split by a hash, and the leaders are folded again under
other hyperplanes, so a group of any size ends in a few classes.

Then NN-descent on the leaders: neighbour lists start from blocks under random hyperplanes.
In each round every node brings its neighbours, and those whose neighbour it is, together;
they are compared with each other, and each keeps the best.  Lists whose last entry may still be a link are saturated and
grow to twice their length.  After each round the recall is audited: leaders in the order of a hash
are compared with all others by brute force, block after block, until they have ``LINKS`` true links or every leader
has had its turn, so an audit without links means that there are none.  Rounds go on until the share of these links that
the lists have is at least ``recall``; a round that starts below it, or with leaders that have no list, also compares
blocks under fresh hyperplanes.

Pairs of classes are linked throughout if the angle between leaders plus both radii is within the
link angle, apart if the difference is beyond it; for the rest their members are compared in
blocks.  Cosines that decide a link are computed in double precision.

Vectors that are null, zero, or have null or non-finite components link with nothing, nor do vectors of different
lengths.  Rows with the same id count as vectors of their own, null ids name no component.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locus.llm.columns import map_groups
from locus.operators.components import contract
from locus.runtime import materialize, sweep

#: Vectors that a task compares with each other when lists start and when classes are folded.
BLOCK, FOLD = 128, 2048
#: Members of a node's set that are compared at once.
SET = 64
#: Entries of a list at first; codes that lists start from; folding rounds.
LIST, STARTS, FOLDS = 8, 3, 3
#: Nodes in the first and in the largest block of an audit; true links that end it.
AUDIT, AUDIT_MOST, LINKS = 200, 2048, 500
#: Rows that are compared with a block of an audit at once.
ROWS = 1024
SLACK = 1e-9


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def arrays(x: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(x).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def nodes_of(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): rows (id, node) of every row, node null if it can't link; nodes (node, vec, mult)."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    largest = F.array_max(F.transform(vec, lambda x: F.abs(x)))
    scaled = F.transform("vec", lambda x: x / F.col("largest"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    rows = (vectors.select(F.col(f"`{id_col}`").alias("id"), F.when(finite & (largest > 0), vec).alias("vec"),
                           largest.alias("largest"))
            .withColumn("vec", scaled).withColumn("norm", norm)
            .withColumn("vec", F.transform("vec", lambda x: x / F.col("norm") + F.lit(0.0)))
            .select("id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2")))
    rows = materialize(rows, "nn-rows")
    nodes = materialize(
        rows.filter("vec IS NOT NULL").groupBy("h1", "h2")
        .agg(F.count("*").alias("mult"), F.min("id").alias("least"), F.any_value("vec").alias("vec"))
        .withColumn("node", F.monotonically_increasing_id()), "nn-nodes")
    rows = rows.select("id", F.when(F.col("vec").isNotNull(), F.col("h1")).alias("h1"), "h2") \
        .join(nodes.select("h1", "h2", "node"), ["h1", "h2"], "left").select("id", "node")
    return rows, nodes


def coded(nodes: DataFrame, bits: int, seed: int, block: int) -> DataFrame:
    """``nodes`` plus (code, salt): signs on random hyperplanes, split into blocks of at most about ``block``."""
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            vecs = batch.column(batch.schema.get_field_index("vec"))
            lengths = pa.compute.list_value_length(vecs).to_numpy()
            codes = np.zeros(len(vecs), np.int64)
            for d in np.unique(lengths):
                if d not in planes:
                    planes[d] = np.random.default_rng((seed, d)).normal(size=(d, bits))
                at = np.flatnonzero(lengths == d)
                signs = matrix(vecs.take(pa.array(at))) @ planes[d] > 0
                codes[at] = signs @ (1 << np.arange(bits)) + (int(d) << bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes)], [*batch.schema.names, "code"])

    import pyarrow.compute  # noqa: F401
    from pyspark.sql.types import LongType, StructType

    out = nodes.mapInArrow(run, StructType([*nodes.schema.fields]).add("code", LongType()))
    out = materialize(out, "nn-coded")
    parts = out.groupBy("code").agg(F.ceil(F.count("*") / block).alias("parts"))
    return (out.join(materialize(parts, "nn-codes"), "code")
            .withColumn("salt", F.pmod(F.xxhash64(F.lit(seed), "node"), "parts")).drop("parts"))


def folded(nodes: DataFrame, half: float) -> tuple[DataFrame, DataFrame]:
    """(classes, members): classes (node, vec, radius), members (node, leader) for every node."""
    def fold(t: pa.Table) -> pa.Table:
        ids, vecs, radius = t["node"].to_numpy(), matrix(t["vec"]), t["radius"].to_numpy().copy()
        # Wide classes lead: they can hardly join another.
        order = np.lexsort((ids, -radius))
        leader, reach = np.full(len(ids), -1), np.zeros(len(ids))
        left = order
        while len(left):
            i = left[0]
            a = angles(vecs[left] @ vecs[i]) + radius[left]
            a[0] = radius[i]
            near = (a <= half) | (np.arange(len(left)) == 0)
            leader[left[near]], reach[i] = i, a[near].max()
            left = left[~near]
        return pa.table({"node": ids, "leader": ids[leader], "radius": reach})

    classes = nodes.select("node", "vec", F.lit(0.0).alias("radius"))
    members: DataFrame | None = None
    for turn in range(FOLDS):
        n = classes.count()
        bits = min(40, max(0, math.ceil(math.log2(max(n / BLOCK, 1)))))
        got = materialize(map_groups(coded(classes, bits, turn, FOLD).select("code", "salt", "node", "vec", "radius"),
                                     ["code", "salt"], fold, "node bigint, leader bigint, radius double"), "nn-fold")
        leaders = got.filter("node = leader").select("node", "radius")
        classes = materialize(classes.select("node", "vec").join(leaders, "node"), "nn-classes")
        step = got.select("node", "leader")
        if members is not None:
            step = members.join(step.select(F.col("node").alias("leader"), F.col("leader").alias("next")), "leader") \
                .select("node", F.col("next").alias("leader"))
        members = materialize(step, "nn-members")
    return classes, members


def best(rows: DataFrame) -> DataFrame:
    """The ``size`` best different entries of each list."""
    from pyspark.sql import Window

    rows = rows.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.max("size").alias("size"))
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    most = Window.partitionBy("u")
    return (rows.withColumn("rank", F.row_number().over(order)).withColumn("size", F.max("size").over(most))
            .filter("rank <= size").select("u", "v", "sim", "size"))


def compared(ids: np.ndarray, vecs: np.ndarray, size: np.ndarray, worst: np.ndarray) -> pa.Table | None:
    """For each node of a set its best others that are better than the worst entry of its list."""
    keep = np.unique(ids, return_index=True)[1]
    ids, vecs, size, worst = ids[keep], vecs[keep], size[keep], worst[keep]
    if len(ids) < 2:
        return None
    sims = vecs @ vecs.T
    np.fill_diagonal(sims, -2)
    k = int(min(size.max(), len(ids) - 1))
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    u = np.repeat(np.arange(len(ids)), k)
    s = sims[u, at.ravel()]
    good = s > worst[u]
    return pa.table({"u": ids[u[good]], "v": ids[at.ravel()[good]], "sim": s[good].astype(np.float64),
                     "size": size[u[good]].astype(np.int32)})


LISTS = "u bigint, v bigint, sim double, size int"


def audited(classes: DataFrame, link: float, reach: float) -> DataFrame:
    """(u, v): all true links of leaders u, taken block after block until they are ``LINKS`` or no leader is left."""
    keyed = classes.select("node", "vec", "radius", F.xxhash64(F.lit(7), "node").alias("key"))
    true, n_true, after, size = None, 0, None, AUDIT
    while True:
        rest = keyed if after is None else keyed.filter(
            (F.col("key") > after[0]) | (F.col("key") == after[0]) & (F.col("node") > after[1]))
        sample = rest.orderBy("key", "node").limit(size).toArrow()  # AUDIT_MOST rows at most
        block = true_links(classes, sample, link, reach)
        true = block if true is None else true.unionByName(block)
        n_true += block.count()
        if n_true >= LINKS or sample.num_rows < size:
            return true
        after = sample["key"][-1].as_py(), sample["node"][-1].as_py()
        size = min(2 * size, AUDIT_MOST)


def true_links(classes: DataFrame, sample: pa.Table, link: float, reach: float) -> DataFrame:
    """(u, v): the links of the nodes u of ``sample``, by brute force."""
    q_ids, q_rad, q_len = sample["node"].to_numpy(), sample["radius"].to_numpy(), np.array([len(v) for v in sample["vec"]])
    q_vecs = {d: matrix(sample["vec"].combine_chunks().take(pa.array(np.flatnonzero(q_len == d)))) for d in np.unique(q_len)}
    least = math.cos(min(math.pi, link + 2 * reach + SLACK)) - SLACK

    def brute(batches):
        for batch in batches:
            us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                ids, rad = part.column(0).to_numpy(), part.column(2).to_numpy()
                lengths = np.array([len(v) for v in part.column(1)])
                for d in np.unique(lengths):
                    if d in q_vecs:
                        mine, at = np.flatnonzero(q_len == d), np.flatnonzero(lengths == d)
                        cosines = matrix(part.column(1).take(pa.array(at))) @ q_vecs[d].T
                        i, j = np.nonzero(cosines >= least)
                        true = angles(cosines[i, j]) <= link + rad[at[i]] + q_rad[mine[j]]
                        us.append(q_ids[mine[j[true]]])
                        vs.append(ids[at[i[true]]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    return materialize(classes.select("node", "vec", "radius").mapInArrow(brute, "u bigint, v bigint")
                       .filter("u != v"), "nn-audit")


def neighbours(classes: DataFrame, link: float, recall: float) -> tuple[DataFrame, list[float]]:
    """(lists, audits): neighbour lists (u, v, sim, size) of the leaders, and the recall after each round."""
    n = classes.count()
    reach = classes.agg(F.max("radius")).first()[0] or 0.0
    bits = min(40, max(0, math.ceil(math.log2(max(n / (BLOCK / 2), 1)))))

    def start(t: pa.Table) -> pa.Table | None:
        ids = t["node"].to_numpy()
        return compared(ids, matrix(t["vec"]), np.full(len(ids), LIST), np.full(len(ids), -2.0))

    lists = None
    for turn in range(STARTS):
        some = map_groups(coded(classes, bits, 100 + turn, BLOCK).select("code", "salt", "node", "vec"),
                          ["code", "salt"], start, LISTS)
        lists = some if lists is None else lists.unionByName(some)
    lists = materialize(best(lists), "nn-lists")

    true = audited(classes, link, reach)
    n_true, audits = true.count(), []
    vecs = classes.select(F.col("node").alias("m"), F.col("vec").cast("array<float>").alias("vec"))
    may_link = math.cos(min(math.pi, link + 2 * reach))
    for turn in itertools.count():
        found = true.join(lists.select("u", "v"), ["u", "v"], "left_semi").count()
        audits.append(found / n_true if n_true else 1.0)  # no true link only if all leaders were audited
        full = lists.groupBy("u").agg(F.count("*").alias("n"), F.min("sim").alias("worst"), F.max("size").alias("size"))
        full = materialize(full, "nn-full")
        saturated = full.filter((F.col("n") >= F.col("size")) & (F.col("worst") >= may_link))
        more = saturated.limit(1).count() > 0
        if turn and audits[-1] >= recall and not more:
            break
        fresh = audits[-1] < recall or full.count() < n
        if more:  # twice as long, and open to anything again
            full = full.withColumn("grown", (F.col("n") >= F.col("size")) & (F.col("worst") >= may_link)) \
                .select("u", "n", F.when(F.col("grown"), F.lit(-2.0)).otherwise(F.col("worst")).alias("worst"),
                        F.when(F.col("grown"), F.col("size") * 2).otherwise(F.col("size")).alias("size"))
        sizes = full.select(F.col("u").alias("m"), F.when(F.col("n") < F.col("size"), -2.0).otherwise(F.col("worst")).alias("worst"),
                            F.col("size").cast("int").alias("size"))
        known = materialize(vecs.join(sizes, "m", "left").select(
            "m", "vec", F.coalesce("worst", F.lit(-2.0)).alias("worst"), F.coalesce("size", F.lit(LIST)).alias("size")), "nn-known")

        # Neighbours of neighbours: every pivot's list, and all whose list it is on.
        sets = (lists.select(F.col("u").alias("pivot"), F.col("v").alias("m"))
                .unionByName(lists.select(F.col("v").alias("pivot"), F.col("u").alias("m")))
                .unionByName(lists.select(F.col("u").alias("pivot"), F.col("u").alias("m"))).distinct())
        count = materialize(sets.groupBy("pivot").agg(F.ceil(F.count("*") / SET).alias("parts")), "nn-pivots")
        sets = (sets.join(count, "pivot").withColumn("part", F.pmod(F.xxhash64(F.lit(turn), "pivot", "m"), "parts"))
                .select("pivot", "part", "m"))

        def meet(t: pa.Table) -> pa.Table | None:
            return compared(t["m"].to_numpy(), matrix(t["vec"]), t["size"].to_numpy(), t["worst"].to_numpy())

        found = map_groups(sets.join(known, "m").select("pivot", "part", "m", "vec", "size", "worst"),
                           ["pivot", "part"], meet, LISTS)
        if fresh:
            known_nodes = known.select(F.col("m").alias("node"), "vec", "size", "worst")
            for i in range(STARTS):
                found = found.unionByName(map_groups(
                    coded(known_nodes, bits, 100 + STARTS * (turn + 1) + i, BLOCK).select("code", "salt", F.col("node").alias("m"), "vec", "size", "worst"),
                    ["code", "salt"], meet, LISTS))
        old = lists.drop("size").join(known.select(F.col("m").alias("u"), "size"), "u").select("u", "v", "sim", "size")
        new = materialize(best(old.unionByName(found)), "nn-lists")
        lists = new
        sweep(classes.sparkSession)
    return lists, audits


def near_duplicates(vectors: DataFrame, threshold: float, id_col: str = "vec_id", vec_col: str = "embedding",
                    recall: float = 0.98) -> DataFrame:
    """(id, n_links, component) for every row of ``vectors``."""
    link = math.acos(threshold)
    rows, nodes = nodes_of(vectors, id_col, vec_col)
    classes, members = folded(nodes.select("node", "vec"), link / 2 - SLACK)
    lists, _ = neighbours(classes, link, recall)

    radius = classes.select("node", "radius")
    pairs = (lists.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
             .join(classes.select(F.col("node").alias("a"), F.col("vec").alias("va"), F.col("radius").alias("ra")), "a")
             .join(classes.select(F.col("node").alias("b"), F.col("vec").alias("vb"), F.col("radius").alias("rb")), "b")
             .withColumn("cos", F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x))
             .withColumn("angle", F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("cos")))))
             .withColumn("r", F.col("ra") + F.col("rb"))
             .filter(F.col("angle") <= link + F.col("r") + SLACK)
             .select("a", "b", "r", ((F.col("r") == 0) & (F.col("cos") >= threshold)
                                     | (F.col("r") > 0) & (F.col("angle") + F.col("r") <= link - SLACK)).alias("whole")))
    pairs = materialize(pairs, "nn-pairs")
    whole = pairs.filter("whole").select("a", "b")

    own = materialize(members.join(nodes.select("node", "mult", "least", "vec"), "node"), "nn-own")
    total = materialize(own.groupBy("leader").agg(F.sum("mult").alias("total"), F.min("least").alias("least")), "nn-total")
    beside = (whole.unionByName(whole.select(F.col("b").alias("a"), F.col("a").alias("b")))
              .join(total.select(F.col("leader").alias("b"), "total"), "b")
              .groupBy(F.col("a").alias("leader")).agg(F.sum("total").alias("beside")))
    of_class = materialize(total.select("leader", "total").join(beside, "leader", "left")
                           .select("leader", (F.col("total") + F.coalesce("beside", F.lit(0)) - 1).alias("links")), "nn-of-class")
    partly = members_linked(pairs.filter(~F.col("whole") & (F.col("r") > 0)), own, threshold)

    edges = whole.unionByName(partly.filter("n > 0").select("a", "b").distinct())
    stars, _ = contract(edges, "a", "b")
    groups = materialize(total.select("leader", "least").join(stars, F.col("leader") == F.col("a"), "left")
                         .select("leader", "least", F.coalesce("b", "leader").alias("root")), "nn-groups")
    named = materialize(groups.groupBy("root").agg(F.min("least").alias("component")), "nn-named")
    named = materialize(groups.join(named, "root").select("leader", "component"), "nn-named")
    extra = partly.groupBy("node").agg(F.sum("n").alias("extra"))
    result = (own.select("node", "leader").join(of_class, "leader").join(named, "leader").join(extra, "node", "left")
              .select("node", (F.col("links") + F.coalesce("extra", F.lit(0))).alias("n_links"), "component"))
    result = materialize(result, "nn-result")
    return (rows.join(result, "node", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component")).alias("component")))


def members_linked(pairs: DataFrame, own: DataFrame, threshold: float) -> DataFrame:
    """(node, a, b, n): links of each member of class a or b to the other class, for pairs that radii don't decide.

    Members are dealt to blocks by a hash; a task compares one block of a with one block of b.
    """
    parts = materialize(own.groupBy("leader").agg(F.ceil(F.count("*") / FOLD).cast("int").alias("parts")), "nn-parts")
    both = (pairs.select("a", "b").join(parts.select(F.col("leader").alias("a"), F.col("parts").alias("pa")), "a")
            .join(parts.select(F.col("leader").alias("b"), F.col("parts").alias("pb")), "b"))
    cells = both.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("pa") - 1))) \
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)))
    dealt = own.join(parts, "leader").select(
        "leader", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("p"), "node", "vec", "mult")
    left = cells.join(dealt.select(F.col("leader").alias("a"), F.col("p").alias("i"), "node", "vec", "mult"), ["a", "i"])
    right = cells.join(dealt.select(F.col("leader").alias("b"), F.col("p").alias("j"), "node", "vec", "mult"), ["b", "j"])
    cols = ["a", "b", "i", "j", "node", "vec", "mult"]
    rows = left.select(*cols, F.lit(0).alias("side")).unionByName(right.select(*cols, F.lit(1).alias("side")))

    def meet(t: pa.Table) -> pa.Table | None:
        side, vecs, ids, mult = t["side"].to_numpy(), matrix(t["vec"]), t["node"].to_numpy(), t["mult"].to_numpy()
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        near = vecs[x] @ vecs[y].T >= threshold
        n = np.concatenate([near @ mult[y], near.T @ mult[x]])
        some = n > 0
        at = np.concatenate([x, y])[some]
        return pa.table({"node": ids[at], "a": t["a"].to_numpy()[at], "b": t["b"].to_numpy()[at], "n": n[some].astype(np.int64)})

    return materialize(map_groups(rows, ["a", "b", "i", "j"], meet, "node bigint, a bigint, b bigint, n bigint"), "nn-members-linked")
