"""Importance resampling towards a target distribution, with CRC buckets of word runs.

Features of a text are all its runs of 1 to ``runs`` consecutive words (``ascii_words``), joined by one space, repeats
counted; a feature's bucket is the unsigned CRC-32 of its UTF-8 bytes modulo ``buckets``.  The CRCs are taken
for many texts together: the distinct features of about ``GROUP`` bytes of text are grouped by their length in bytes,
each group is one two-dimensional uint8 array (a row a feature), and one table step a column brings all CRCs of the
group forward by a byte; the buckets are then scattered back to the places of the features in the texts.

Every document's bucket counts are written once (at most ``buckets`` of them, however long the text), beside one row of totals a task, so
neither the corpus counts nor the weights tokenise again.  The totals are summed and come back as ``buckets`` rows, a bound set by the parameter.  A bucket's gain is the log ratio of target and corpus, a document's weight the
sum of the gains of its features, its score the weight plus Gumbel noise from a hash of its id; the highest
scores among texts of ``min_words`` words or more are the draw, without replacement.  Their ranks
come from one range-partitioned sort of (score, id) rows.

Nulls and texts without a word have no feature, weight 0 and their noise as the score; they are never drawn.  Every row is a document of its own,
also if its id repeats (equal ids have equal noise; ties of score and id go by features and weight).  A null id hashes as an empty one and comes last among ties.
An empty target, or an empty corpus, still gives every bucket a gain (the counts are smoothed by one).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import batched, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from locus.llm.ascii_words import pieces
from locus.operators.ids import with_sequential_id
from locus.runtime import materialize

#: Bytes of text whose distinct features are taken together, and of a piece of a text.
GROUP, PIECE = 1 << 21, 1 << 20
#: Texts at most whose counts are taken together (each has an array of all buckets for that time) and given back at once.
TEXTS = 500
#: Bytes of a matrix.
MATRIX = 1 << 18
#: The reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def crc_table() -> np.ndarray:
    """The CRC of each byte on its own, by the polynomial."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = (out >> np.uint32(1)) ^ (np.uint32(POLYNOMIAL) * (out & np.uint32(1)))
    return out


TABLE = crc_table()


def crc_columns(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a two-dimensional uint8 array, column by column."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = TABLE[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
    return ~crc


def crc_of_runs(words: list[bytes], runs: np.ndarray) -> np.ndarray:
    """CRC-32 of word runs: ``runs`` holds a run a row, as numbers of ``words``; words are joined by one space."""
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(lens) - lens
    text = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    total = lens[runs].sum(axis=1)
    order = np.argsort(total, kind="stable")
    out = np.empty(len(runs), np.uint32)
    edges = np.flatnonzero(np.diff(total[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        width = int(total[order[a]])
        # Rows of equal length, a matrix of them at once; each ends with a space that is left out.
        step = max(1, MATRIX // width)
        for lo in range(a, b, step):
            some = order[lo:min(lo + step, b)]
            parts = runs[some].ravel()
            n = lens[parts]
            ends = np.cumsum(n)
            flat = text[np.arange(ends[-1]) + np.repeat(starts[parts] - ends + n, n)]
            out[some] = crc_columns(flat.reshape(len(some), width)[:, :-1])
    return out


class Numbers(dict):
    """Words numbered in the order they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def feature_buckets(lists: list[tuple[int, list[bytes]]], runs: int, buckets: int) -> list[np.ndarray]:
    """For each (old, words): the buckets of all word runs that end after the first ``old`` words."""
    number = Numbers()
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words for _, words in lists)), np.int64)
    words = list(number)
    sizes = np.array([len(w) for _, w in lists], np.int64)
    end = np.repeat(np.cumsum(sizes), sizes)
    fresh = np.repeat(np.cumsum(sizes) - sizes + np.array([old for old, _ in lists], np.int64), sizes)
    owner = np.repeat(np.arange(len(lists)), sizes)
    at = np.arange(len(ids))
    group = distinct = None
    got: list[tuple[np.ndarray, np.ndarray]] = []
    for r in range(1, runs + 1):
        # Runs of r words: those of r - 1 words, known by number, and one word more.
        at = at[at + r <= end[at]]
        if not len(at):
            break
        if r == 1:
            distinct, group = np.arange(len(words))[:, None], ids.copy()
        else:
            key, group_at = np.unique(group[at] * len(words) + ids[at + r - 1], return_inverse=True)
            distinct = np.column_stack([distinct[key // len(words)], key % len(words)])
            group = np.zeros(len(ids), np.int64)
            group[at] = group_at
        crc = (crc_of_runs(words, distinct) % np.uint32(buckets)).astype(np.int64)
        new = at[at + r > fresh[at]]
        got.append((owner[new], crc[group[new]]))
    out: list[list[np.ndarray]] = [[] for _ in lists]
    for who, bucket in got:
        cuts = np.searchsorted(who, np.arange(len(lists) + 1))
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                out[i].append(bucket[a:b])
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def bucket_counts(texts: Iterator[bytes | None], runs: int, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each text in turn: words, features, its buckets and how many features each has."""
    waiting: list[tuple[int, np.ndarray]] = []  # [words, counts] of texts that are not given out yet
    group: list[tuple[int, int, list[bytes]]] = []
    size = 0

    def flush() -> None:
        found = feature_buckets([(old, words) for _, old, words in group], runs, buckets)
        for (who, _, _), b in zip(group, found):
            waiting[who][1][:] += np.bincount(b, minlength=buckets)
        group.clear()

    def done(n: int):
        for words, counts in waiting[:n]:
            has = np.flatnonzero(counts)
            yield words, int(counts.sum()), has, counts[has]
        del waiting[:n]

    for text in texts:
        waiting.append([0, np.zeros(buckets, np.int32)])
        for _, old, words in pieces(text or b"", runs - 1, PIECE):
            waiting[-1][0] += len(words) - old
            group.append((len(waiting) - 1, old, words))
            size += sum(map(len, words))
            if size >= GROUP:
                flush()
                size = 0
        # A text without further pieces is whole; so are all before it.
        if not group or len(waiting) >= TEXTS:
            flush()
            size = 0
            yield from done(len(waiting))
    flush()
    yield from done(len(waiting))


def narrow(x: np.ndarray, top: int) -> np.ndarray:
    """Unsigned little-endian numbers in the least of 1, 2, 4 or 8 bytes that hold ``top``."""
    return x.astype(np.min_scalar_type(int(top)).newbyteorder("<"))


def wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}") if n else np.zeros(0, np.uint8)


def features(docs: DataFrame, runs: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """(id, total, n_words, n_features, buckets, counts) for every row, and one row of ``total`` for every task: the counts of
    all its rows.  The last two columns are packed numbers: the buckets, and how many features each has."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "total", "n_words", "n_features", "buckets", "counts"]

    def part(batches):
        total, id_type = np.zeros(buckets, np.int64), None
        for batch in batches:
            id_type = batch.column(0).type
            at = 0
            for found in batched(bucket_counts((t.as_py() for t in batch.column(1)), runs, buckets), TEXTS):
                words, n, has, counts = zip(*found)
                for b, c in zip(has, counts):
                    total[b] += c
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(found)), pa.array([False] * len(found)), pa.array(words, pa.int64()), pa.array(n, pa.int64()),
                     pa.array([narrow(b, buckets).tobytes() for b in has], pa.binary()),
                     pa.array([narrow(c, c.max(initial=0)).tobytes() for c in counts], pa.binary())], names)
                at += len(found)
        has = np.flatnonzero(total)
        if len(has):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.array([True]), pa.array([0]), pa.array([int(total.sum())]),
                 pa.array([narrow(has, buckets).tobytes()], pa.binary()), pa.array([total[has].astype("<u8").tobytes()], pa.binary())], names)
        pa.default_memory_pool().release_unused()

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")).mapInArrow(
        part, f"id {kind}, total boolean, n_words bigint, n_features bigint, buckets binary, counts binary")


def numbers(bucket: pa.BinaryScalar, count: pa.BinaryScalar, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The packed buckets and counts of a row."""
    at = bucket.as_py()
    at = np.frombuffer(at, f"<u{np.min_scalar_type(size).itemsize}")
    return at, wide(count.as_py(), len(at))


def totals(table: DataFrame, buckets: int) -> np.ndarray:
    """Features of the whole table by bucket: the tasks' own totals, summed; ``buckets`` rows come back."""
    def part(batches):
        out = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in zip(batch.column(0), batch.column(1)):
                at, n = numbers(*row, buckets)
                out[at] += n.astype(np.int64)
        has = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(out[has])], ["bucket", "n"])

    rows = table.filter("total").select("buckets", "counts").mapInArrow(part, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1) (S + buckets) / ((s + 1) (T + buckets)))) for each bucket, in doubles."""
    n = float(len(corpus))
    all_s, all_t = float(corpus.sum()) + n, float(target.sum()) + n
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t)))
                     for s, t in zip(map(float, corpus), map(float, target))], np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) for a u in (0, 1) from the first 32 bits of a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.log(-F.log(u)) * -1000.0).cast("bigint")


def weigh(table: DataFrame, gains: np.ndarray) -> DataFrame:
    """(id, n_words, n_features, weight) of a features table."""
    kind = table.schema["id"].dataType.simpleString()

    def part(batches):
        for batch in batches:
            weight = []
            for row in zip(batch.column(3), batch.column(4)):
                at, n = numbers(*row, len(gains))
                weight.append(int(gains[at] @ n.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(3)], pa.array(weight, pa.int64())],
                                             ["id", "n_words", "n_features", "weight"])

    return table.filter("NOT total").select("id", "n_words", "n_features", "buckets", "counts").mapInArrow(
        part, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, runs: int = 3, buckets: int = 10_000, min_words: int = 20,
             percent: int = 5, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) for every row of ``docs``; ``rank`` is null where it isn't drawn."""
    table = materialize(features(docs, runs, buckets, id_col, text_col), "importance-features")
    # The target's rows need no id.
    wanted = features(target.select(F.lit(0).alias("id"), F.col(f"`{text_col}`").alias("text")), runs, buckets, "id", "text")
    gains = bucket_gains(totals(table, buckets), totals(wanted, buckets))
    scored = materialize(weigh(table, gains).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "importance-scores")
    able = scored.filter(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    ranked = with_sequential_id(
        able.select("*", (-F.col("score")).alias("_down"), F.col("id").isNull().alias("_last")),
        ["_down", "_last", "id", "n_features", "weight"], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    cols = [F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(cols).unionByName(rest.select(cols))
