"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: a text's word shingles are hashed to 64 bits (XXH64); a bit of the
fingerprint is set if it is set in over half of the hashes, repeats included.

Search (Pagh, covering LSH): each of the 64 bits gets a nonzero vector of r + 1
bits, r being the radius.  For each nonzero vector v of r + 1 bits there is a table
whose key keeps the bits whose vector has an odd product with v.  Two fingerprints
that differ in at most r bits span at most r dimensions, so some v is orthogonal to
all of them: that table's key keeps none of the differing bits and the two collide
there.  No pair within the radius is missed: 2^(r+1) - 1 tables, no other check than
the distance.

Documents of one fingerprint are one node.  A bucket (table, key) is searched in the
task that holds it and gives one edge from each fingerprint to its local root, never
all pairs.  A bucket of more than ``BUCKET`` fingerprints is not sent to one task: it
is hashed again by covering masks over the bits that its key leaves free, which
again miss no pair; what still shares a bucket then goes in blocks, pair of blocks by pair of
blocks.  Components come from the library's star contraction, which runs on
written tables.

Nulls and empty texts have fingerprint zero and are linked like any other.  Rows
with the same id or a null id are rows of their own; a component's id is the least
id in it (null if it has none).  Extra columns are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from locus.llm.columns import map_rows, texts
from locus.operators.components import contract
from locus.runtime import materialize

BITS = 64
#: Fingerprints of a bucket that one task compares with each other.
BUCKET = 4096
SEED = 42


def fingerprint(text: str, shingle: int) -> int:
    """``text`` with A-Z lower-cased; words are split at ASCII white space."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())], "<u8")
    set_in = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)]
        set_in += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * set_in > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, hash): the 64 bits as a signed long, and a hash of the text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(row):
        yield row[0], signed(fingerprint(row[1], shingle)), row[2]

    hashed = texts(docs, id_col, text_col).withColumn("hash", F.xxhash64("text"))
    return map_rows(hashed, rows, f"id {kind}, fp bigint, hash bigint")


def covering_masks(radius: int, bits: int = BITS, skip: int = 0) -> list[int]:
    """Masks over the bits not in ``skip`` such that any ``radius`` of these bits are all left out by one."""
    vectors = [v for v in product((0, 1), repeat=radius + 1) if any(v)]
    free = [i for i in range(bits) if not skip >> i & 1]
    given = {bit: vectors[k % len(vectors)] for k, bit in enumerate(free)}
    return [sum(1 << bit for bit, m in given.items() if sum(a * b for a, b in zip(m, v)) % 2) for v in vectors]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def keyed(fps: DataFrame, masks: Column, *more: str) -> DataFrame:
    """A row for each fingerprint and mask: (table, key, fp)."""
    out = fps.select("fp", *more, F.posexplode(masks).alias("table", "mask"))
    return out.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).drop("mask")


def local_roots(fps: np.ndarray, radius: int, block: int = 256) -> np.ndarray:
    """The least fingerprint that each one reaches by links inside a bucket (sorted ``fps``)."""
    root, left = np.arange(len(fps)), np.arange(len(fps))
    while len(left):
        first, left = left[0], left[1:]
        front = np.array([first])
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for i in range(0, len(front), block):
                differ = np.bitwise_count(fps[front[i:i + block], None] ^ fps[None, left])
                near |= (differ <= radius).any(axis=0)
            front, left = left[near], left[~near]
            root[front] = first
    return fps[root]


def bucket_edges(rows: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Edges (src, dst) between each fingerprint and its local root, bucket by bucket.

    ``rows`` are dealt out and sorted by ``keys``; a bucket has at most a bounded number
    of rows, so a task holds one Arrow batch and one bucket at a time.
    """
    def run(batches):
        rest: list[np.ndarray] | None = None

        def edges(cols: list[np.ndarray], last: bool) -> tuple[pa.RecordBatch, list[np.ndarray]]:
            *key, fp = cols
            n = len(fp)
            new = np.ones(n, bool)
            if n:
                new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
            starts = np.append(np.flatnonzero(new), n)
            upto = n if last else (int(starts[-2]) if n else 0)
            src, dst = [], []
            many = np.flatnonzero(np.diff(starts) > 1)
            for g in many:
                a, b = int(starts[g]), int(starts[g + 1])
                if a >= upto:
                    break
                group = np.unique(fp[a:b].view(np.uint64))
                roots = local_roots(group, radius)
                off = roots != group
                src.append(group[off].view(np.int64))
                dst.append(roots[off].view(np.int64))
            join = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
            return pa.RecordBatch.from_arrays([join(src), join(dst)], ["src", "dst"]), [c[upto:] for c in cols]

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols)]
            out, rest = edges(cols, False)
            yield out
        if rest is not None:
            yield edges(rest, True)[0]

    dealt = rows.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "src bigint, dst bigint")


def links(fps: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Edges (src, dst) that connect exactly the distinct fingerprints (``fp``) that links connect."""
    masks = [signed(m) for m in covering_masks(radius)]
    rows = keyed(fps, F.array(*map(F.lit, masks)))
    large = (rows.groupBy("table", "key").count().filter(F.col("count") > bucket)
             .select("table", "key"))
    large = materialize(large, "simhash-large")
    if large.isEmpty():
        return bucket_edges(rows, ["table", "key"], radius)
    few = bucket_edges(rows.join(large, ["table", "key"], "left_anti"), ["table", "key"], radius)
    # Inside a bucket all rows agree on its mask, so pairs differ in the other bits only.
    inner = F.array(*[F.array(*[F.lit(signed(m)) for m in covering_masks(radius, skip=m0 & (1 << 64) - 1)])
                      for m0 in masks])
    again = keyed(rows.join(large, ["table", "key"], "left_semi").select("fp", F.col("table").alias("t"),
                                                                         F.col("key").alias("k")),
                  inner[F.col("t")], "t", "k")
    return few.union(block_edges(again, ["t", "k", "table", "key"], radius, bucket))


def block_edges(rows: DataFrame, keys: list[str], radius: int, bucket: int) -> DataFrame:
    """As ``bucket_edges`` for buckets of any size: rows are numbered into blocks by a hash, and each
    pair of blocks of a bucket is a group of its own of about two blocks' rows."""
    sized = rows.groupBy(*keys).agg(F.ceil(F.count("*") * 2 / bucket).cast("int").alias("blocks"))
    sized = materialize(sized, "simhash-blocks")
    rows = rows.join(sized, keys).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    pairs = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other"))
    return bucket_edges(pairs, [*keys, "p", "q"], radius)


def near_duplicates(docs: DataFrame, shingle: int, radius: int, id_col: str = "doc_id",
                    text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(id, fp, component, hash, root) for every row of ``docs``.

    component: the least id reachable by links; hash: of the text; root: the same for all rows that links connect.
    """
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash-fps")
    nodes = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    stars, _ = contract(links(nodes, radius, bucket))
    groups = materialize(
        nodes.join(stars, nodes["fp"] == stars["a"], "left")
        .select("fp", "least", F.coalesce("b", "fp").alias("root")), "simhash-groups")
    least = materialize(groups.groupBy("root").agg(F.min("least").alias("component")), "simhash-least")
    named = materialize(groups.join(least, "root").select("fp", "component", "root"), "simhash-named")
    return (rows.join(named, "fp")
            .select(F.col("id").alias(id_col), "fp", "component", "hash", "root"))


def representatives(docs: DataFrame, shingle: int, radius: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group that links connect: one with the least id, whole and unchanged."""
    found = near_duplicates(docs, shingle, radius, id_col, text_col)
    kept = (found.filter(F.col(id_col).eqNullSafe(F.col("component"))).groupBy("root")
            .agg(F.any_value(id_col).alias("_id"), F.min("hash").alias("_hash")).select("_id", "_hash"))
    kept = materialize(kept, "simhash-kept")
    own = docs.withColumn("_text_hash", F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))
    return (own.join(kept, own[id_col].eqNullSafe(kept["_id"]) & (F.col("_text_hash") == F.col("_hash")), "left_semi")
            .dropDuplicates([id_col, "_text_hash"]).drop("_text_hash"))


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
