"""License scans by diagonal voting.

Words (``ascii_words``) of every text and of every template are hashed in rolling windows of ``long`` words, and of ``short``
words for templates with fewer than ``long``.

1. Tasks emit all window hashes of all texts, in rows of a bounded piece of a text each; Spark explodes them and
   joins them with the places of the templates' windows (a table whose size the templates set; it is broadcast after a
   check of its bytes).
2. A match votes for the diagonal on which it lies: the place in the text less the place in the template, which is
   where the template would start.  Votes are summed by (row, template, diagonal); the set of template places that voted is what counts, so
   copies of a row don't add to it.
3. Diagonals of a template that differ by at most a tenth of its words are one span: what was put in or left out shifts the rest.
   Exact templates don't merge.  Spans in which fewer than ``MIN_VOTES`` of the template's windows voted are dropped (exact ones need all).
4. Every span is verified on the words of the text: an exact template's words must all be there; else the template is
   aligned with the words around (edits of words; free ends), and must be alike to ``similarity`` (1 - edits / words).

A null or empty text has no words and no span.  A row is known by its id and a hash of its text; rows that are equal in both have the
same spans, and each gives a row.  Ids may be null or repeat.  Extra columns don't matter.  An empty template list gives no span.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from locus.llm.ascii_words import count, pieces
from locus.llm.columns import map_rows
from locus.llm.license_texts import NOTICES, PHRASES, Template
from locus.llm.word_windows import window_hashes, word_hashes
from locus.operators.joins import checked_broadcast, join_small
from locus.runtime import materialize

TEMPLATES = PHRASES + NOTICES
#: Words of a window, and of one of a template that has fewer.
LONG, SHORT = 5, 2
#: Part of a template's windows that must vote before a span is verified, and the likeness it must then show.
MIN_VOTES, SIMILARITY = 0.2, 0.8
SPAN = "struct<label: string, template: int, exact: boolean, start: bigint, end: bigint, similarity: double>"


def template_words(template: Template) -> list[bytes]:
    return [w for _, _, words in pieces(template.text.encode()) for w in words]


def window_of(words: Sequence[bytes], long: int, short: int) -> int:
    if len(words) < short:
        raise ValueError(f"a template needs at least {short} words")
    return long if len(words) >= long else short


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each window of k words; it also tells windows of another k apart."""
    return (window_hashes(hashes, k) + np.uint64(k)).view(np.int64)


def template_places(spark: SparkSession, templates: Sequence[Template], long: int, short: int) -> DataFrame:
    """(h, template, place): every window of every template; as many rows as the templates have words at most."""
    rows = []
    for t, template in enumerate(templates):
        words = template_words(template)
        found = windows(word_hashes(words), window_of(words, long, short))
        rows += [(int(h), t, i) for i, h in enumerate(found)]
    return spark.createDataFrame(rows, "h bigint, template int, place bigint")


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")) \
        .select("id", F.xxhash64("text").alias("hash"), F.col("text").cast("binary").alias("text"))


def text_windows(rows: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(id, hash, first, hashes): all windows of k words, for each k of ``sizes``; ``first`` is the place of the first of a row's windows."""
    kind = rows.schema["id"].dataType.simpleString()

    def of_text(row):
        key, digest, text = row
        for first, old, words in pieces(text, max(sizes) - 1):
            hashes = word_hashes(words)
            for k in sizes:
                # Windows that end in a new word; those before were given with the piece before.
                skip = max(old - k + 1, 0)
                found = windows(hashes[skip:], k)
                if len(found):
                    yield key, digest, first + skip, found

    return map_rows(rows, of_text, f"id {kind}, hash bigint, first bigint, hashes array<bigint>")


def votes(rows: DataFrame, templates: Sequence[Template], long: int = LONG, short: int = SHORT) -> DataFrame:
    """(id, hash, template, diagonal, places): the template places that voted for a diagonal of a text."""
    sizes = sorted({window_of(template_words(t), long, short) for t in templates})
    places = template_places(rows.sparkSession, templates, long, short)
    each = text_windows(rows, sizes).select("id", "hash", "first", F.posexplode("hashes").alias("i", "h"))
    hits = each.join(checked_broadcast(places), "h")
    return hits.groupBy("id", "hash", "template", (F.col("first") + F.col("i") - F.col("place")).alias("diagonal")) \
        .agg(F.collect_set("place").alias("places"))


def spans(voted: DataFrame, templates: Sequence[Template], long: int = LONG, short: int = SHORT,
          min_votes: float = MIN_VOTES) -> DataFrame:
    """(id, hash, template, start, end): spans to verify; ``end`` is exclusive."""
    spark = voted.sparkSession
    facts = []
    for t, template in enumerate(templates):
        words = template_words(template)
        windows = len(words) - window_of(words, long, short) + 1
        facts.append((t, len(words), 0 if template.exact else max(1, len(words) // 10),
                      float(windows if template.exact else max(1.0, min_votes * windows))))
    facts = spark.createDataFrame(facts, "template int, words bigint, gap bigint, least double")
    of = Window.partitionBy("id", "hash", "template").orderBy("diagonal")
    runs = voted.join(checked_broadcast(facts), "template").withColumn("new", (
        F.col("diagonal") - F.lag("diagonal").over(of) > F.col("gap")).cast("int")) \
        .withColumn("run", F.sum(F.coalesce("new", F.lit(1))).over(of))
    return runs.groupBy("id", "hash", "template", "run").agg(
        F.min("diagonal").alias("first"), F.max("diagonal").alias("last"), F.first("words").alias("words"), F.first("least").alias("least"),
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("voted")) \
        .filter(F.col("voted") >= F.col("least")) \
        .select("id", "hash", "template", F.col("first").alias("start"), (F.col("last") + F.col("words")).alias("end"))


# --- verification

def align(template: Sequence[bytes], words: Sequence[bytes]) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of ``words`` that is nearest to the template in edits of words; of several the first that ends."""
    n = len(words)
    cost, begin = [0] * (n + 1), list(range(n + 1))
    for i, want in enumerate(template, 1):
        last, last_begin = cost[0], begin[0]
        cost[0] = i
        for j in range(1, n + 1):
            options = ((last + (words[j - 1] != want), last_begin), (cost[j] + 1, begin[j]), (cost[j - 1] + 1, begin[j - 1]))
            last, last_begin = cost[j], begin[j]
            cost[j], begin[j] = min(options, key=lambda x: x[0])
    end = min(range(n + 1), key=cost.__getitem__)
    return cost[end], begin[end], end


def windows_of(text: bytes, wanted: list[tuple[int, int]]) -> tuple[int, list[list[bytes]]]:
    """The number of words, and the words of each wanted (start, end), which are sorted by their starts."""
    out: list[list[bytes]] = [[] for _ in wanted]
    nearby: list[int] = []
    up = n = 0
    for first, _, words in pieces(text):
        n = first + len(words)
        while up < len(wanted) and wanted[up][0] < n:
            nearby.append(up)
            up += 1
        for i in nearby:
            lo, hi = wanted[i]
            out[i] += words[max(lo - first, 0):max(hi - first, 0)]
        nearby = [i for i in nearby if wanted[i][1] > n]
    return n, out


def verified(text: bytes, found: list[dict] | None, templates: Sequence[Template], words: Sequence[list[bytes]],
             similarity: float) -> tuple[int, list[tuple]]:
    """The number of words of a text, and its spans that hold, by start."""
    if not found:
        return count(text), []
    wanted = []
    for x in found:
        slack = 0 if templates[x["template"]].exact else max(1, len(words[x["template"]]) // 10)
        wanted.append((max(x["start"] - slack, 0), x["end"] + slack, x["template"]))
    wanted.sort()
    n, texts = windows_of(text, [x[:2] for x in wanted])
    out = set()
    for (start, _, t), around in zip(wanted, texts):
        want = words[t]
        if templates[t].exact:
            if around == want:
                out.add((start, start + len(want), t, 1.0))
            continue
        edits, a, b = align(want, around)
        if len(want) - edits >= similarity * len(want):
            out.add((start + a, start + b, t, 1.0 - edits / len(want)))
    return n, [(templates[t].label, t, templates[t].exact, start, end, alike) for start, end, t, alike in sorted(out)]


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, similarity: float = SIMILARITY, long: int = LONG,
         short: int = SHORT, min_votes: float = MIN_VOTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, spans) for every row; a span is (label, template, exact, start, end, similarity), words counted from 0."""
    rows = text_rows(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    words = [template_words(t) for t in templates]
    found = F.lit(None).cast("array<struct<template:int,start:bigint,end:bigint>>").alias("found")
    if templates:
        near = spans(votes(rows, templates, long, short), templates, long, short, min_votes)
        near = materialize(near.groupBy(F.col("id").alias("near_id"), F.col("hash").alias("near_hash")).agg(
            F.collect_list(F.struct("template", "start", "end")).alias("found")), "license-spans")
        rows = join_small(rows, near, F.col("id").eqNullSafe(F.col("near_id")) & (F.col("hash") == F.col("near_hash")), "left")
        found = F.col("found")
    rows = rows.select("id", "text", found)

    def check(row):
        yield row[0], *verified(row[1], row[2], templates, words, similarity)

    return map_rows(rows, check, f"id {kind}, n_words bigint, spans array<{SPAN}>").withColumnRenamed("id", id_col)
