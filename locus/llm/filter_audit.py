"""Filter interaction audit: what each filter of a chain removes, in every order, by source.

Every text gets a mask of the filters it fails.  Filters A to D look at one text (``text_filters``); filter E, exact
duplicates, needs them all and is found with radix tries:

1. Each task puts the texts it reads into a compressed trie, up to ``LOCAL_BYTES`` at a time, with the least id at each
   terminal.  A row whose text has a smaller id there is a duplicate for certain and moves on without
   its text; equal rows become one with a count.  So of a group of copies, however large, a task sends on one text.
2. What is left is range-partitioned by text prefixes.  They are adaptive: prefixes start at ``HEAD`` code points, and one whose texts
   weigh more than ``TRIE_BYTES`` is made four times as long, until none does or the prefix is the whole text.  The
   bytes are summed by prefix in Spark; only the heavy prefixes (at most total / ``TRIE_BYTES`` of them) are looked up.
3. Each range inserts its full texts into one trie and walks it: a row is a duplicate if the terminal's least id is smaller than its own.

Rows are then (id, part, mask, count) without text.  They are summed by (id, part, mask), joined with the labels by id,
summed by (part, mask) - at most 32 cells a part - and one small matrix product a part gives every figure of all 120 orders.

A null text is empty, a null source the empty part, and a null id larger than every id: its row is a duplicate of any row with an id,
and rows with a null id, or with equal ids, aren't duplicates of one another.  Every row counts, also if it repeats.  A label row with a null id
labels nothing; of several label rows of an id, any 1 counts.  An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locus.llm.text_trie import TextTrie
from locus.operators.joins import checked_broadcast
from locus.runtime import materialize

FILTERS = "ABCDE"
DUPLICATE = FILTERS.index("E")
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SIGNS = b"#$%&*|"
MIN_WORDS = 200
#: Bytes of text of a task's own trie and of a range's, and what a row weighs besides its text.
LOCAL_BYTES, TRIE_BYTES, ROW_BYTES = 16 << 20, 32 << 20, 300
#: Code points of the shortest prefix.
HEAD = 16


def text_filters(text: bytes) -> int:
    """The filters A to D that a UTF-8 text fails, as bits."""
    words = text.split()
    n = len(words)
    points = n_points(text)
    few = n < MIN_WORDS
    repetitive = 100 * len(set(words)) < 50 * n
    shouting = 100 * (len(text) - len(text.translate(None, UPPER))) > 2 * points
    signs = len(text) != len(text.translate(None, SIGNS))
    return few | repetitive << 1 | shouting << 2 | signs << 3


def n_points(text: bytes) -> int:
    return len(text) if text.isascii() else len(text.decode("utf-8", "replace"))


# --- masks

def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask, n): n rows of ``docs`` with that id and part fail the filters of the mask."""
    kind = docs.schema[id_col].dataType.simpleString()
    local = rows_of(docs, id_col, text_col, part_col).mapInArrow(local_tries, f"id {kind}, part string, mask int, n bigint, text binary")
    local = materialize(local.withColumns({
        "weight": F.octet_length("text") + ROW_BYTES, "head": F.substring(F.col("text").cast("string"), 1, HEAD)}), "audit-local")
    open_rows = local.filter("weight IS NOT NULL")
    total = open_rows.agg(F.sum("weight")).first()[0] or 0
    ranged = with_prefixes(open_rows).repartitionByRange(max(1, -(-total // TRIE_BYTES)), "prefix")
    closed = ranged.select("id", "part", "mask", "n", "text").mapInArrow(range_trie, f"id {kind}, part string, mask int, n bigint")
    return closed.unionByName(local.filter("weight IS NULL").select("id", "part", "mask", "n"))


def rows_of(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("text"))


def local_tries(batches):
    """Masks of rows; the text goes along where only the other tasks' rows can tell if it is a duplicate."""
    trie, size = TextTrie(), 0

    def flush():
        for text, least, rows in trie.walk():
            mask = text_filters(text)
            same: dict[tuple, int] = {}
            for row in rows:
                same[row] = same.get(row, 0) + 1
            for (key, part), n in same.items():
                gone = least is not None and (key is None or key > least)
                yield key, part, mask | gone << DUPLICATE, n, None if gone else text

    for batch in batches:
        for key, part, text in zip(*batch.columns):
            text = text.as_py()
            trie.add(text, key.as_py(), (part.as_py(),))
            size += len(text) + ROW_BYTES
            if size >= LOCAL_BYTES:
                yield from in_batches(flush(), batch.column(0).type, True)
                trie, size = TextTrie(), 0
        kind = batch.column(0).type
    if size:
        yield from in_batches(flush(), kind, True)
    pa.default_memory_pool().release_unused()


def range_trie(batches):
    """Masks of the rows of one range, with the duplicates among them."""
    trie, kind = TextTrie(), None
    for batch in batches:
        kind = batch.column(0).type
        for key, part, mask, n, text in zip(*batch.columns):
            trie.add(text.as_py(), key.as_py(), (part.as_py(), mask.as_py(), n.as_py()))
    if kind is not None:
        yield from in_batches(((key, part, mask | (least is not None and (key is None or key > least)) << DUPLICATE, n)
                               for _, least, rows in trie.walk() for key, part, mask, n in rows), kind, False)
    pa.default_memory_pool().release_unused()


def in_batches(rows: Iterator[tuple], id_type: pa.DataType, with_text: bool) -> Iterator[pa.RecordBatch]:
    """Batches of at most 2,000 rows or about 8 MB of text."""
    schema = pa.schema([("id", id_type), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())]
                       + ([("text", pa.binary())] if with_text else []))
    out: list[tuple] = []
    size = 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    for row in rows:
        out.append(row)
        size += len(row[-1] or b"") if with_text else 0
        if len(out) >= 2000 or size >= 8 << 20:
            yield batch()
            out.clear()
            size = 0
    if out:
        yield batch()


def with_prefixes(rows: DataFrame, head: int = HEAD, most: int = TRIE_BYTES) -> DataFrame:
    """``rows`` with a column ``prefix``: the shortest of its text's prefixes of head, 4 head, 16 head ... code points
    whose texts weigh at most ``most`` bytes, or the whole text."""
    length = head
    out = rows.withColumn("prefix", F.col("head"))
    heaviest = (out.groupBy("prefix").agg(F.sum("weight").alias("w")).filter(F.col("w") > most).select(F.col("prefix").alias("heavy")))
    heaviest = materialize(heaviest, "audit-heavy")
    while not heaviest.isEmpty():
        length *= 4
        longer = F.substring(F.col("text").cast("string"), 1, length)
        out = out.join(checked_broadcast(heaviest), F.col("prefix") == F.col("heavy"), "left") \
            .withColumn("prefix", F.when(F.col("heavy").isNotNull(), longer).otherwise(F.col("prefix"))).drop("heavy")
        # Prefixes as long as this were just made; those of whole texts can't get longer.
        heaviest = materialize(
            out.filter(F.length("prefix") == length).groupBy("prefix")
            .agg(F.sum("weight").alias("w"), F.max(F.octet_length("text") - F.octet_length("prefix")).alias("more"))
            .filter((F.col("w") > most) & (F.col("more") > 0)).select(F.col("prefix").alias("heavy")), "audit-heavy")
    return out


# --- reduction

def cells(masked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): at most 32 rows a part."""
    rows = masked.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    flag = lambda c: F.max((F.col(f"`{c}`") == 1).cast("int"))
    known = labels.filter(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("labelled")) \
        .agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    share = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c)
    return (rows.join(known, F.col("id") == F.col("labelled"), "left")
            .groupBy("part", "mask").agg(F.sum("n").alias("all"), share("good"), share("toxic")).withColumnRenamed("all", "n"))


class Orders:
    """What every order does with every mask, as matrices of 0 and 1: a row for each (order, step), a column a mask."""

    def __init__(self, letters: str = FILTERS):
        n = len(letters)
        orders = list(permutations(range(n)))
        self.names = ["".join(letters[f] for f in order) for order in orders for _ in order]
        self.step = np.tile(np.arange(1, n + 1), len(orders))
        self.filter = np.array(orders).ravel()
        mask = np.arange(1 << n)
        before = np.array([sum(1 << f for f in order[:i]) for order in orders for i in range(n)])[:, None]
        fails = mask >> self.filter[:, None] & 1
        earlier = (mask & before != 0).astype(np.int64)
        self.removed, self.redundant = fails * (1 - earlier), fails * earlier
        self.kept = (mask & (before | 1 << self.filter[:, None]) == 0).astype(np.int64)
        self.alone = (mask == 1 << self.filter[:, None]).astype(np.int64)

    def figures(self, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
        """A row for each (order, step) from the counts of each mask."""
        removed = self.removed @ n
        every = np.zeros(self.filter.max() + 1, np.int64)
        np.add.at(every, self.filter, removed)
        return {"kept": self.kept @ n, "removed": removed, "redundant": self.redundant @ n, "unique_fails": self.alone @ n,
                "good_lost": self.removed @ good, "toxic_lost": self.removed @ toxic, "shapley": every[self.filter]}


REPORT = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
          "good_lost bigint, toxic_lost bigint, shapley bigint")


def report(counted: DataFrame) -> DataFrame:
    """All orders and steps of every part; a part's list of cells has at most 32 entries."""
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def figures(batches):
        orders = Orders()
        rows = len(orders.names)
        for batch in batches:
            for part, entries in zip(batch.column(0), batch.column(1)):
                counts = np.zeros((3, 1 << len(FILTERS)), np.int64)
                for cell in entries.as_py():
                    counts[:, cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
                out = orders.figures(*counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * rows), pa.array(orders.names), pa.array(orders.step.astype(np.int32)),
                     *[pa.array(v.astype(np.int64)) for v in out.values()]], ["part", "filter_order", "step", *out])

    return parts.mapInArrow(figures, REPORT)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row for each part, order of the five filters and step of it."""
    return report(cells(masks(docs, id_col, text_col, part_col), labels, id_col))
