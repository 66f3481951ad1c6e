"""Reversible line deduplication: sharded cuckoo filters over exact reference counts.

A line's key is the line without white space at its ends, A-Z in lower case; it is
known by two 64-bit hashes.  The index holds, for each key, the number of documents
that have it (the exact table), and for each shard of keys a cuckoo filter.  To add
documents, their keys are counted first (a document counts once for a key; partial
sums, so a line that stands everywhere moves one row per task), and each shard then takes its
own counts: a key that the filter rules out is new and needs no look-up, any other
is looked up in the exact table.  Deleting documents subtracts; a key that no document
has any more leaves both table and filter, so adding and then deleting documents gives the
index back.  Each update writes a new version.

``drop`` removes, in any documents, the lines whose key at least ``min_docs`` indexed
documents have.  Keys shorter than ``min_chars`` code points always stay.

Nulls and empty texts are one empty line.  Every row is a document of its own, also if
its id repeats or is null.  Extra columns may be carried along whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from locus.llm.columns import map_rows
from locus.llm.cuckoo import CuckooFilter
from locus.runtime import discard, materialize, scratch_path

#: Keys of a shard; beyond that, keys are dealt anew over twice as many shards.
SHARD_KEYS = 1 << 16
SPACE = b" \t\n\x0b\x0c\r"
VERSION = "shard int, h1 bigint, h2 bigint, n bigint, filter binary"


def line_keys(text: str, min_chars: int) -> list[tuple[int, int] | None]:
    """For each line the two hashes of its key; None if the key is too short."""
    out: list[tuple[int, int] | None] = []
    for line in text.encode().split(b"\n"):
        key = line.strip(SPACE).lower()
        if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
            out.append(None)
        else:
            out.append((signed(xxhash.xxh64_intdigest(key, 1)), signed(xxhash.xxh64_intdigest(key, 2))))
    return out


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@dataclass
class LineIndex:
    """One version of the index: exact counts and filters, in one table."""

    spark: SparkSession
    min_chars: int
    shards: int = 1
    path: str | None = None

    @property
    def version(self) -> DataFrame:
        if not self.path:
            return self.spark.createDataFrame([], VERSION)
        return self.spark.read.schema(VERSION).parquet(self.path)

    @property
    def counts(self) -> DataFrame:
        """(h1, h2, n): the documents that have each key."""
        return self.version.filter("n > 0").select("h1", "h2", "n")

    @property
    def filters(self) -> DataFrame:
        return self.version.filter("filter IS NOT NULL").select("shard", "filter")

    def insert(self, docs: DataFrame, text_col: str = "text") -> LineIndex:
        return self.update(docs, text_col, 1)

    def delete(self, docs: DataFrame, text_col: str = "text") -> LineIndex:
        """Take out documents that were inserted before; keys unknown to the index are ignored."""
        return self.update(docs, text_col, -1)

    def update(self, docs: DataFrame, text_col: str, sign: int) -> LineIndex:
        min_chars = self.min_chars

        def keys(row):
            yield from dict.fromkeys(k for k in line_keys(row[0], min_chars) if k)

        text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
        delta_path = scratch_path(self.spark, "line-delta")
        delta = materialize(
            map_rows(docs.select(text.alias("text")), keys, "h1 bigint, h2 bigint")
            .groupBy("h1", "h2").agg((F.count("*") * sign).alias("n")), path=delta_path)
        most = (self.counts.count() if self.path else 0) + delta.count()
        shards = self.shards
        while shards * SHARD_KEYS < most:
            shards *= 2
        old = self.counts.select("h1", "h2", "n", F.lit(False).alias("new"))
        rows = old.union(delta.select("h1", "h2", "n", F.lit(True).alias("new"))) \
            .withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
        # With the shards dealt anew, filters are built again from the exact table.
        filters = self.filters if shards == self.shards else self.spark.createDataFrame([], "shard int, filter binary")
        path = scratch_path(self.spark, "line-index")
        (rows.groupBy("shard").cogroup(filters.groupBy("shard"))
         .applyInPandas(update_shard, VERSION).write.parquet(path))
        discard(self.spark, delta_path)
        return LineIndex(self.spark, min_chars, shards, path)

    def drop(self, docs: DataFrame, min_docs: int, id_col: str = "doc_id", text_col: str = "text",
             carry: list[str] | None = None) -> DataFrame:
        """(id, n_lines, n_dropped, kept, *carry) for every row of ``docs``."""
        min_chars = self.min_chars
        kind = docs.schema[id_col].dataType.simpleString()
        rows = docs.select(
            F.struct(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry or [])]).alias("row"),
            F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")) \
            .withColumn("id", F.col("row.id")).withColumn("hash", F.xxhash64("text"))

        def places(row):
            for i, key in enumerate(line_keys(row[2], min_chars)):
                if key:
                    yield *row[:2], i, *key

        lines = map_rows(rows.select("id", "hash", "text"), places,
                         f"id {kind}, hash bigint, line int, h1 bigint, h2 bigint")
        hot = self.counts.filter(F.col("n") >= min_docs).select("h1", "h2")
        # A row is known by its id and the hash of its text; rows equal in both lose the same lines.
        cut = (lines.join(hot, ["h1", "h2"], "left_semi")
               .groupBy(F.col("id").alias("cid"), F.col("hash").alias("chash"))
               .agg(F.collect_set("line").alias("lines")))
        cut = materialize(cut, "line-cut")
        both = rows.join(cut, F.col("id").eqNullSafe(F.col("cid")) & (F.col("hash") == F.col("chash")), "left")
        out = both.select("row", "text", "lines").mapInArrow(
            without_lines, f"row {rows.schema['row'].dataType.simpleString()}, "
                           "n_lines bigint, n_dropped bigint, kept string")
        return out.select(F.col("row.id").alias(id_col), "n_lines", "n_dropped", "kept",
                          *[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(carry or [])])


def without_lines(batches):
    for batch in batches:
        n_lines, n_dropped, kept = [], [], []
        for text, lines in zip(batch.column(1), batch.column(2)):
            all_lines = text.as_py().split("\n")
            gone = set(lines.as_py() or ())
            n_lines.append(len(all_lines))
            n_dropped.append(len(gone))
            kept.append("\n".join([x for i, x in enumerate(all_lines) if i not in gone]) if gone else text.as_py())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
            ["row", "n_lines", "n_dropped", "kept"])


def update_shard(key: tuple, rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """The new version of one shard (bounded by ``SHARD_KEYS``): its counts, then its filter."""
    is_new = rows["new"].astype(bool)
    old, new = rows[~is_new], rows[is_new]
    counts = old.set_index(["h1", "h2"])["n"]
    if len(filters):
        known = CuckooFilter.from_bytes(filters["filter"].iloc[0])
    else:
        known = CuckooFilter.of(old["h1"].to_numpy(), old["h2"].to_numpy())
    maybe = known.contains(new["h1"].to_numpy(), new["h2"].to_numpy())
    delta = new.set_index(["h1", "h2"])["n"]
    seen = delta[maybe].index.intersection(counts.index)
    fresh = delta.drop(seen)
    fresh = fresh[fresh > 0]
    counts.loc[seen] += delta.loc[seen]
    gone = counts.index[counts.to_numpy() <= 0]
    known.remove(*columns(gone))
    counts = pd.concat([counts.drop(gone), fresh])
    if not known.insert(*columns(fresh.index)):
        known = CuckooFilter.of(*columns(counts.index))
    h1, h2 = columns(counts.index)
    return pd.concat([
        pd.DataFrame({"shard": key[0], "h1": h1, "h2": h2, "n": counts.to_numpy(np.int64), "filter": None}),
        pd.DataFrame({"shard": [key[0]], "h1": [None], "h2": [None], "n": [None], "filter": [known.to_bytes()]},
                     dtype=object)])


def columns(index: pd.MultiIndex) -> tuple[np.ndarray, np.ndarray]:
    return (index.get_level_values(0).to_numpy(np.int64), index.get_level_values(1).to_numpy(np.int64))
