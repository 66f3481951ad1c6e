"""Order MinHash fingerprints, sensitive to edit distance.

A text is its words (runs of anything but ASCII white space; longer runs are cut every ``RUN`` code
points).  Its elements are the k-mers of words, each with the number of its occurrence (the
second "a b" is not the first).  All elements are hashed once; the hash's leading bits deal them to
``BINS`` bins.  A bin keeps its ``KEPT`` least elements and puts them back into text order: their hashes
in that order, hashed again, are the bin's entry.  So texts agree in a bin if they share its
least elements and have them in the same order.  The likeness of two fingerprints is the
share of bins, of those that either uses, that agree; two empty ones are alike.

All of it is array functions within a row: sorting a text's k-mers numbers their occurrences, sorting the
elements by hash makes the bins.  Nothing is exploded, and the text moves once (plus the part of
it that the document before it takes).

Nulls and empty texts have no words.  Documents are ordered by id, then by hashes of the row; a null id
comes last in descending order.  Rows equal in id and text are one place in that order and get the same
result each; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from locus.llm.columns import hex_digest, texts
from locus.operators.ids import with_sequential_id
from locus.runtime import materialize, sweep

#: Words of a k-mer, elements that a bin keeps, log2 of the bins, code points of a word at most.
K, KEPT, BIN_BITS, RUN = 2, 2, 6, 16
BINS = 1 << BIN_BITS


def let(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def bin_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BIN_BITS)


def signature(text: Column) -> Column:
    """array<int>: for each bin in use, its number in the leading bits and its entry in the others."""
    words = F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{RUN}}}"), F.lit(0))

    def kmers(w: Column) -> Column:
        places = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.greatest(F.size(w) - K, F.lit(0)))) \
            .otherwise(F.array().cast("array<int>"))
        return F.sort_array(F.transform(places, lambda i: F.struct(
            F.xxhash64(*[F.get(w, i + j) for j in range(K)]).alias("h"), i.alias("p"))))

    def elements(s: Column) -> Column:
        # Runs of equal k-mers, by the places where they start; the last entry ends the last run.
        every = F.sequence(F.lit(0), F.size(s) - 1)
        starts = F.filter(every, lambda i: (i == 0) | (F.get(s, i)["h"] != F.get(s, i - 1)["h"]))

        def numbered(x: Column) -> Column:
            run = lambda a, j: F.transform(
                F.sequence(a, F.coalesce(F.get(x, j + 1), F.size(s)) - 1),
                lambda i: F.struct(F.xxhash64(F.get(s, i)["h"], i - a).alias("h"), F.get(s, i)["p"].alias("p")))
            return F.sort_array(F.flatten(F.transform(x, run)))

        return F.when(F.size(s) > 0, let(starts, numbered)).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))

    def least(e: Column) -> Column:
        return F.filter(e, lambda x, i: (i < KEPT) | (bin_of(F.get(e, i - KEPT)["h"]) != bin_of(x["h"])))

    def entries(e: Column) -> Column:
        def entry(x: Column, i: Column) -> Column:
            own = F.filter(F.transform(F.array(*[F.lit(j) for j in range(KEPT)]), lambda j: F.get(e, i + j)),
                           lambda y: y.isNotNull() & (bin_of(y["h"]) == bin_of(x["h"])))
            order = F.transform(F.sort_array(F.transform(own, lambda y: F.struct(y["p"], y["h"].alias("h")))), lambda y: y["h"])
            # The elements of a bin share its leading bits; the entry's other bits are of their hash.
            low = F.shiftrightunsigned(F.xxhash64(order), 32 + BIN_BITS)
            whole = F.shiftleft(bin_of(x["h"]), 32 - BIN_BITS).bitwiseOR(low)
            signed = F.when(whole >= 1 << 31, whole - (1 << 32)).otherwise(whole).cast("int")
            return F.when((i == 0) | (bin_of(F.get(e, i - 1)["h"]) != bin_of(x["h"])), signed)
        return F.array_compact(F.transform(e, entry))

    return let(let(let(let(words, kmers), elements), least), entries)


def likeness(a: Column, b: Column) -> Column:
    bins = lambda s: F.transform(s, lambda x: F.shiftrightunsigned(x, 32 - BIN_BITS))
    union = F.size(F.array_union(bins(a), bins(b)))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def text_of(signature_: Column) -> Column:
    """The fingerprint as text: 8 hex digits for each bin in use."""
    return F.array_join(F.array_sort(F.transform(signature_, lambda x: F.lower(
        F.lpad(F.hex(x.cast("bigint").bitwiseAND(F.lit((1 << 32) - 1))), 8, "0")))), "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_id) for every row.

    The edited text has its last third replaced by the beginning of the next document, in descending order of ids.
    """
    rows = texts(docs, id_col, text_col).select(
        "id", "text", F.xxhash64(F.struct("id"), "text").alias("h1"), F.xxhash64(F.lit(2), F.struct("id"), "text").alias("h2"))
    ranked = with_sequential_id(
        rows.select("id", "h1", "h2", F.length("text").alias("n")).distinct(), ["id", "h1", "h2"], "rank")
    ranked = materialize(ranked, "omh-rank")
    n = ranked.count()
    # The document before (in descending order) takes the first third of its own length from this one.
    takers = ranked.select(F.when(F.col("rank") == 1, F.lit(n)).otherwise(F.col("rank") - 1).alias("rank"),
                           F.col("h1").alias("t1"), F.col("h2").alias("t2"), F.floor(F.col("n") / 3).cast("int").alias("need"))
    takers = materialize(ranked.select("h1", "h2", "rank").join(takers, "rank").drop("rank"), "omh-takers")
    # Both uses of the rows need the same columns, dealt out alike: Spark moves the texts once.
    given = (rows.join(takers, ["h1", "h2"])
             .select("t1", "t2", F.col("h1").alias("n1"), F.col("h2").alias("n2"), F.col("id").alias("next_id"),
                     F.left("text", F.col("need")).alias("begin"))
             .dropDuplicates(["t1", "t2"]))
    both = rows.join(given, (F.col("h1") == F.col("t1")) & (F.col("h2") == F.col("t2")))
    length = F.length("text")
    edited = F.concat(F.left("text", (length - F.floor(length / 3)).cast("int")), F.col("begin"))
    out = (both.withColumn("edited", edited)
           .select("id", "h1", "h2", "n1", "n2", "next_id", length.cast("bigint").alias("n_chars"),
                   hex_digest(F.col("edited")).alias("edited_sha256"),
                   signature(F.col("text")).alias("sig"), signature(F.col("edited")).alias("edited_sig")))
    out = materialize(out, "omh-signatures")
    sweep(docs.sparkSession)
    following = out.select(F.col("h1").alias("n1"), F.col("h2").alias("n2"), F.col("sig").alias("next_sig")) \
        .dropDuplicates(["n1", "n2"])
    return out.join(following, ["n1", "n2"]).select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", text_of(F.col("sig")).alias("fingerprint"),
        text_of(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"), "next_id")
