"""Best-fit packing with certified bin counts.

Documents become token pieces of at most one sequence each.  A full piece is a
sequence.  The others are dealt to partitions by a hash of their key, and each
partition packs its own by best-fit decreasing (open sequences are looked up by the
space they have left, so a piece takes constant time).

Dual feasible functions bound each partition from below: if f never gives the
items of one sequence more than 1 in total, the sum of f over all pieces is at most the number of
sequences of any packing.  Two families are tried over all their parameters:
thresholds (pieces over 1 - e count as 1, those under e as 0) and roundings (to
multiples of 1/(k+1)).  A partition whose count meets its bound is certified.

Partitions with a gap give up the pieces of their sequences that have room, these
are dealt anew to fewer partitions, and best-fit decreasing runs again.  Rounds
end once the whole count meets the bound of all pieces, or a round saves nothing.  As
partitions are bounded and pieces are dealt by hash, no task grows with the
data; only one row per partition (count and bound) and the histogram of lengths (one row for
each length up to the capacity) reach the driver.

Token ids come from ``byte_bpe``, which leaves stretches of a text to the library.

A null or empty text is one piece with the closing id only.  Every row is a
document of its own, also if its id repeats or is null; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from locus.llm.byte_bpe import codec
from locus.llm.columns import map_rows, texts
from locus.runtime import discard, materialize, scratch_path

#: Pieces of a partition, and pre-tokens that a worker remembers besides whole runs.
GROUP, PRE_TOKENS = 4096, 50_000


def pieces(docs: DataFrame, path: str, pattern: str, capacity: int, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, crc): each document's ids and ``end_id``, cut from the end."""
    kind = docs.schema[id_col].dataType.simpleString()
    closing = int(end_id).to_bytes(4, "little")

    def rows(row):
        ids = codec(path, pattern, True, PRE_TOKENS).encode_whole(row[1]) + closing
        n = len(ids) // 4
        cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield row[0], i, a, b - a, zlib.crc32(ids[4 * a:4 * b])

    return map_rows(texts(docs, id_col, text_col), rows,
                    f"id {kind}, piece int, start bigint, length bigint, crc bigint")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each item, space left in each bin) by best-fit in the given order."""
    bins = np.empty(len(lengths), np.int64)
    left: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has r left
    for i, n in enumerate(lengths.tolist()):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(left)
            left.append(capacity)
        bins[i] = b
        left[b] = room - n
        if room > n:
            if not with_room[room - n]:
                rooms ^= 1 << room - n
            with_room[room - n].append(b)
    return bins, np.array(left, np.int64)


def lower_bound(histogram: np.ndarray, capacity: int, roundings: int = 64) -> float:
    """The best dual-feasible bound, not rounded; ``histogram[n]`` items have length n."""
    n = np.arange(capacity + 1)
    count = np.zeros(capacity + 1, np.int64)
    count[:len(histogram)] = histogram
    size, items = np.append(0, np.cumsum(count * n)), np.append(0, np.cumsum(count))
    e = np.arange(capacity // 2 + 1)
    # Items over capacity - e count 1, those from e to capacity - e their size.
    large = items[-1] - items[capacity - e + 1]
    middle = size[capacity - e + 1] - size[e]
    best = float((large + middle / capacity).max())
    for k in range(1, roundings + 1):
        product = (k + 1) * n
        value = np.where(product % capacity == 0, n / capacity, product // capacity / k)
        best = max(best, float((value * count).sum()))
    return best


def packed(capacity: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        """One partition: (key, length, sequence, offset, room, bound)."""
        pdf = pdf.sort_values(["length", "key"], ascending=[False, True], kind="stable")
        lengths = pdf["length"].to_numpy(np.int64)
        bins, left = best_fit(lengths, capacity)
        first = pd.Series(pdf["key"].to_numpy()).groupby(bins).transform("min").to_numpy()
        ends = pd.Series(lengths).groupby(bins).cumsum().to_numpy()
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        return pd.DataFrame({"key": pdf["key"].to_numpy(), "length": lengths, "sequence": first,
                             "offset": ends - lengths, "room": left[bins], "bound": bound,
                             "part": pdf["part"].to_numpy()})
    return pack


def pack(docs: DataFrame, path: str, pattern: str, capacity: int, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text", group: int = GROUP) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of ``docs``."""
    spark = docs.sparkSession
    # Written once: the keys stay as they are however often a later stage is run again.
    table = materialize(pieces(docs, path, pattern, capacity, end_id, id_col, text_col)
                        .withColumn("key", F.monotonically_increasing_id()), "pack-pieces")
    places = place(table.select("key", "length"), capacity, group)
    return (table.join(places, "key")
            .select(F.col("id").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"),
                    F.col("sequence").alias("sequence_id"), "offset"))


def place(items: DataFrame, capacity: int, group: int = GROUP) -> DataFrame:
    """(key, sequence, offset) for items (key, length); a sequence is named by its least key."""
    spark = items.sparkSession
    done = [items.filter(F.col("length") == capacity)
            .select("key", F.col("key").alias("sequence"), F.lit(0).cast("bigint").alias("offset"))]
    loose = items.filter(F.col("length") < capacity)
    before: tuple[DataFrame, int] | None = None  # the packing of the loose pieces so far
    for turn in range(1, 1 << 30):
        n = loose.count()
        if not n:
            break
        dealt = loose.withColumn(
            "part", F.pmod(F.xxhash64(F.lit(turn), "key"), F.lit(-(-n // group))).cast("int"))
        path = scratch_path(spark, "pack-round")
        got = materialize(dealt.groupBy("part").applyInPandas(
            packed(capacity), "key bigint, length bigint, sequence bigint, offset bigint, room bigint, "
                              "bound double, part int"), path=path)
        starts = got.filter("offset = 0")
        parts = starts.groupBy("part").agg(F.count("*").alias("n"), F.first("bound").alias("bound"))
        # A count within one of the bound can't be improved by this partition alone, but the
        # unused fractions of several partitions add up, so every gap counts here.
        gaps = [r["part"] for r in parts.collect() if r["n"] > r["bound"] + 1e-6]
        sequences = starts.count()
        if before and sequences >= before[1]:
            discard(spark, path)
            break
        histogram = np.zeros(capacity + 1, np.int64)
        for r in got.groupBy("length").count().collect():  # at most a row for each length
            histogram[r["length"]] = r["count"]
        certified = sequences <= np.ceil(lower_bound(histogram, capacity) - 1e-6)
        if certified or not gaps:
            before = got, sequences
            break
        # Full sequences, and those of partitions without a gap, stay; the others are dealt anew.
        open_parts = spark.createDataFrame([(p,) for p in gaps], "part int")
        opened = F.col("room") > 0
        kept = got.filter(~opened).unionByName(got.filter(opened).join(F.broadcast(open_parts), "part", "left_anti"))
        done.append(kept.select("key", "sequence", "offset"))
        rest = got.filter(opened).join(F.broadcast(open_parts), "part", "left_semi")
        before = rest, rest.filter("offset = 0").count()
        loose = rest.select("key", "length")
    if before:
        done.append(before[0].select("key", "sequence", "offset"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
