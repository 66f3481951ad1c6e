"""Substring deduplication by level-wise doubling.

A word goes if a window of ``length`` words that covers it also starts in a document
with a smaller id.  Windows are judged on the input, not on what is left.

Level 0: documents that are the same words throughout.  Only the one with the smallest id
goes on; of the others everything goes that a window covers.
Level 1: windows of half the length.  Not all of them: of every ``length`` words those
with the least hash, a choice that depends on these words only, so equal windows choose
alike (about one window in thirteen for 50 words).  Those found in one document only are done.
Level 2: windows repeated at half the length, and these alone, are extended to windows of twice
that length, in every way that a window of ``length`` words can hold them.  Those that
also start in a smaller document are what is removed.

Levels double from ``length / 2``; as ``length`` is what is asked for, none is left to
extend beyond it.

Counting sends a row for each window hash and document (a document repeats a hash once),
summed before the shuffle; rows find the smallest document of their hash by a join of two written
tables, which adaptive execution splits where a passage is in very many
documents.  Windows are compared by 96 bits of two independent hashes.

Nulls and empty texts have no words.  A null id counts as larger than any other; rows
with the same id are no smaller than each other.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from locus.llm.columns import map_rows, texts
from locus.llm.word_windows import anchors, window_hashes, word_hashes, words_of
from locus.runtime import discard, materialize, scratch_path, sweep

#: Stands for a null id when documents are ordered.
LAST = (1 << 63) - 1
BYTES_OUT = 8 << 20


def sequence_hash(words: list[bytes]) -> tuple[int, int]:
    """128 bits of the whole word sequence, as two signed longs."""
    data = xxhash.xxh3_128_digest(b" ".join(words))
    return int.from_bytes(data[:8], "little", signed=True), int.from_bytes(data[8:], "little", signed=True)


def window_pairs(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """96 bits for each window: a signed long and a signed int."""
    return (window_hashes(hashes, length).view(np.int64),
            (window_hashes(hashes, length, 1) >> np.uint64(32)).astype(np.uint32).view(np.int32))


def holding(at: np.ndarray, short: int, length: int, n_windows: int) -> np.ndarray:
    """The windows of ``length`` that hold a window of ``short`` words at one of the places ``at``."""
    steps = np.zeros(n_windows + 1, np.int64)
    np.add.at(steps, np.maximum(at - (length - short), 0), 1)
    np.add.at(steps, np.minimum(at, n_windows - 1) + 1, -1)
    return np.flatnonzero(np.cumsum(steps[:-1]) > 0)


def covered(starts: np.ndarray, length: int, n_words: int) -> np.ndarray:
    """For each word whether a window that starts at one of ``starts`` covers it."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:-1]) > 0


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """(o, t, whole, windows): for each document (o: its id, ``LAST`` if null; t: hash of its text) that loses
    words, what it loses: all that windows cover (whole), or the windows with the listed hashes.

    ``docs`` has o, t and text.  Rows equal in o and t are the same words, so one list bounded by a document
    serves them, however many rows share an id.
    """
    spark = docs.sparkSession
    short = -(-length // 2)
    paths: list[str] = []

    def written(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, f"substring-{name}"))
        return materialize(df, path=paths[-1])

    def head(row):
        o, t, text = row
        words = words_of(text)
        if len(words) >= length:
            d1, d2 = sequence_hash(words)
            yield o, t, d1, d2, np.unique(anchors(word_hashes(words), short, length)[1]).view(np.int64).tolist()

    heads = written(map_rows(docs, head, "o bigint, t bigint, d1 bigint, d2 bigint, anchors array<bigint>"), "heads")
    first = written(heads.groupBy("d1", "d2").agg(F.min("o").alias("first"), F.max("o").alias("last"))
                    .filter("first < last").select("d1", "d2", "first"), "first")
    copies = written(heads.select("o", "t", "d1", "d2").join(first, ["d1", "d2"]).filter("o > first")
                     .select("o", "t").distinct(), "copies")
    live = written(heads.join(copies, ["o", "t"], "left_anti"), "live")
    sweep(spark)

    each = live.select("o", "t", F.explode("anchors").alias("a"))
    twice = written(each.groupBy("a").agg(F.min("o").alias("low"), F.max("o").alias("high"))
                    .filter("low < high").select("a"), "anchors")
    wanted = written(each.join(twice, "a", "left_semi").groupBy("o", "t").agg(F.collect_set("a").alias("wanted")), "wanted")
    sweep(spark)

    def extend(batches):
        for batch in batches:
            out, size = [], 0
            for o, t, text, want in zip(*batch.columns):
                h = word_hashes(words_of(text.as_py()))
                at, a = anchors(h, short, length)
                at = at[np.isin(a.view(np.int64), want.values.to_numpy())]
                w1, w2 = window_pairs(h, length)
                keep = holding(at, short, length, len(w1))
                _, one = np.unique(w1[keep], return_index=True)
                keep = keep[one]
                out.append((w1[keep], w2[keep], np.full(len(keep), o.as_py()), np.full(len(keep), t.as_py())))
                size += len(keep) * 28
                if size >= BYTES_OUT:
                    yield columns(out)
                    out, size = [], 0
            if out:
                yield columns(out)

    def columns(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["w1", "w2", "o", "t"])

    windows = written(docs.join(wanted, ["o", "t"]).select("o", "t", "text", "wanted")
                      .mapInArrow(extend, "w1 bigint, w2 int, o bigint, t bigint"), "windows")
    sweep(spark)
    low = written(windows.groupBy("w1", "w2").agg(F.min("o").alias("first"), F.max("o").alias("last"))
                  .filter("first < last").select("w1", "w2", "first"), "low")
    lost = (windows.join(low, ["w1", "w2"]).filter("o > first")
            .groupBy("o", "t").agg(F.collect_set(F.struct("w1", "w2")).alias("windows")))
    cuts = (lost.select("o", "t", F.lit(False).alias("whole"), "windows")
            .unionByName(copies.select("o", "t", F.lit(True).alias("whole"),
                                       F.lit(None).cast("array<struct<w1:bigint,w2:int>>").alias("windows"))))
    cuts = materialize(cuts, "substring-cuts")
    discard(spark, *paths)
    sweep(spark)
    return cuts


def dedup(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept) for every row of ``docs``; kept: the words left, one space between."""
    rows = texts(docs, id_col, text_col).withColumn("o", F.coalesce(F.col("id").cast("bigint"), F.lit(LAST))) \
        .withColumn("t", F.xxhash64("text"))
    cuts = repeated_windows(rows.select("o", "t", "text"), length)

    def cut(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, whole, some in zip(*batch.columns[1:]):
                words = words_of(text.as_py())
                gone = np.zeros(len(words), bool)
                if whole.as_py():
                    gone[:] = True
                elif some.is_valid:
                    w1, w2 = window_pairs(word_hashes(words), length)
                    hit = member(w1, w2, some.values.field("w1").to_numpy(), some.values.field("w2").to_numpy())
                    gone = covered(np.flatnonzero(hit), length, len(words))
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                left = words if not n_removed[-1] else [w for w, g in zip(words, gone.tolist()) if not g]
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string())], [id_col, "n_words", "n_removed", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (rows.join(cuts, ["o", "t"], "left").select("id", "text", "whole", "windows")
            .mapInArrow(cut, f"`{id_col}` {kind}, n_words bigint, n_removed bigint, kept string"))


def member(w1: np.ndarray, w2: np.ndarray, have1: np.ndarray, have2: np.ndarray) -> np.ndarray:
    """Whether each pair (w1, w2) is among the pairs (have1, have2), whose first parts differ."""
    if not len(have1):
        return np.zeros(len(w1), bool)
    order = np.argsort(have1)
    have1, have2 = have1[order], have2[order]
    at = np.minimum(np.searchsorted(have1, w1), len(have1) - 1)
    return (have1[at] == w1) & (have2[at] == w2)
