"""Personal data by patterns, and information-theoretic sanitisation around it.

Base: e-mail addresses, IP addresses, card and phone numbers, each by its pattern, leftmost and without
overlap within a kind; matches that fail their check (parts, Luhn, digits) are dropped.  Every base string
is a protected entity.

Terms: words of letters next to an entity (within ``CONTEXT`` code points) may give it away even
when it is masked.  Over all documents, texts that are equal counting once, with c(.) the number of texts that
have an entity, a term, or the term next to the entity, and N all texts:

    disclosure(term, entity) = log2(N c(t, e) / (c(t) c(e))) / log2(N / c(e))

that is pointwise mutual information as a share of the entity's information: 1 means that the term
occurs with this entity only.  A term with at least ``SUPPORT`` texts next to an entity that
discloses more than ``GENERALISE`` of it is replaced by a general word wherever it stands in a text that
holds the entity; one that discloses more than ``REMOVE`` is taken out.  Cards and phones are the same entity if their
digits are.

All of it is DataFrame functions.  Patterns are written so that matching is linear: a run of the
leading class is entered at its start only (or where the last match ended).  Positions come
from the lengths of what stands between matches, summed in blocks; a text with n matches takes about n^1.5 short steps.  Term counts over the corpus are taken for terms that are next to some
entity often enough; a table of at most ``BUCKETS`` hash values rules out nearly all other words
before they are shuffled.

Nulls and empty texts have no spans.  Every row is judged on its own, also if its id repeats or is null; other
columns may be carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from locus.runtime import materialize

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns; possessive repeats and the look-behind change no match, only the time to fail.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WORD = r"\p{L}{3,}"
CONTEXT = 60
SUPPORT, GENERALISE, REMOVE = 3, 0.8, 0.95
BUCKETS = 1 << 20
#: Code points of a block, in which places are looked up.
BLOCK = 256
SPAN = "struct<s:int,e:int,kind:string,m:string,l:string,r:string>"


def let(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def running(values: Column, op, start: int) -> Column:
    """``op`` over each element and all before it; blocks of about sqrt(n) keep the copying small."""
    def through(x: Column) -> Column:
        def step(acc: Column, v: Column) -> Column:
            now = op(acc["now"], v)
            return F.struct(now.alias("now"), F.array_append(acc["out"], now).alias("out"))

        zero = F.struct(F.lit(start).alias("now"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(x, zero, step, lambda acc: acc["out"])

    def whole(x: Column) -> Column:
        n, b = F.size(x), F.ceil(F.sqrt(F.size(x))).cast("int")
        inner = F.transform(F.sequence(F.lit(0), ((n - 1) / b).cast("int")), lambda k: through(F.slice(x, k * b + 1, b)))
        return let(inner, lambda y: let(through(F.transform(y, lambda z: F.element_at(z, -1))), lambda ends: F.flatten(
            F.transform(y, lambda z, i: F.when(i == 0, z).otherwise(
                let(F.get(ends, i - 1), lambda before: F.transform(z, lambda v: op(before, v))))))))

    return let(values, lambda x: F.when(F.size(x) == 0, x).otherwise(whole(x)))


def added(a: Column, b: Column) -> Column:
    return (a + b).cast("int")


def found(text: Column, pattern: str, kind: str) -> Column:
    """All matches in order: (s, e, kind, m); l and r are empty."""
    def walk(x: Column) -> Column:
        both = F.zip_with(F.slice(x["g"], 1, F.size(x["m"])), x["m"], lambda g, m: F.length(g) + F.length(m))
        return F.zip_with(x["m"], running(both, added, 0), lambda m, e: F.struct(
            (e - F.length(m)).alias("s"), e.alias("e"), F.lit(kind).alias("kind"), m.alias("m"),
            F.lit("").alias("l"), F.lit("").alias("r")).cast(SPAN))

    return let(F.struct(F.split(text, pattern, -1).alias("g"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")), walk)


def blocks(text: Column) -> Column:
    """``text`` in blocks of ``BLOCK`` code points: finding a place in a string takes as long as what stands before it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def cut(parts: Column, start: Column, n: Column) -> Column:
    """``n`` code points from ``start`` (from 0) of the text in ``blocks``."""
    first = F.floor(start / BLOCK).cast("int")
    some = F.slice(parts, first + 1, F.floor((start + n) / BLOCK).cast("int") - first + 1)
    return F.substr(F.array_join(some, ""), start - first * BLOCK + 1, n)


def beside(text: Column, spans: Column) -> Column:
    """``spans`` with the text within ``CONTEXT`` code points of each as l and r, whatever matches stand there."""
    def sides(parts: Column) -> Column:
        return F.transform(spans, lambda x: x.withField("l", cut(parts, F.greatest(x["s"] - CONTEXT, F.lit(0)),
                                                                 F.least(x["s"], F.lit(CONTEXT))))
                           .withField("r", cut(parts, x["e"], F.lit(CONTEXT))))

    return let(blocks(text), sides)


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(d: Column) -> Column:
    def value(i: Column) -> Column:
        v = F.substr(d, F.length(d) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return v - F.when(v > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(d) - 1), value), F.lit(0), lambda a, v: a + v) % 10 == 0


def valid(kind: str):
    if kind == "ip":
        return lambda x: x["m"].rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        return lambda x: let(digits(x["m"]), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return lambda x: F.length(digits(x["m"])).between(10, 15)
    return lambda x: F.lit(True)


def base_spans(text: Column) -> Column:
    """The base spans of every kind, by start and then kind."""
    some = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    none = F.array().cast(f"array<{SPAN}>")
    near = lambda x: F.when(F.size(x) > 0, beside(text, x)).otherwise(x)
    every = [F.when(some.get(k, text.rlike("[0-9]")), let(F.filter(found(text, PATTERNS[k], k), valid(k)), near)).otherwise(none)
             for k in KINDS]
    return ordered(F.concat(*every))


def ordered(spans: Column) -> Column:
    """By start, then kind as listed; added kinds come last."""
    kinds = F.array(*[F.lit(k) for k in (*KINDS, "term", "gone")])
    key = lambda x: F.struct(x["s"], F.array_position(kinds, x["kind"]).alias("k"), x["e"], x.alias("x"))
    return F.transform(F.array_sort(F.transform(spans, key)), lambda y: y["x"])


def terms(side: str, x: Column) -> Column:
    """Words next to a span, in lower case, with what it names; a word cut off by the window is left out."""
    text = x[side]
    cut = F.length(text) == CONTEXT
    whole = (lambda w: ~cut | (w["s"] > 0)) if side == "l" else (lambda w: ~cut | (w["e"] < CONTEXT))
    return F.transform(F.filter(found(text, WORD, "term"), whole), lambda w: F.struct(
        F.lower(w["m"]).alias("term"), entity(x).alias("entity")))


def entity(x: Column) -> Column:
    """What a span names: cards and phones by their digits, however they are written; others in lower case."""
    name = F.when(x["kind"].isin("card", "phone"), digits(x["m"])).otherwise(F.lower(x["m"]))
    return F.concat_ws(":", x["kind"], name)


def disclosing(near: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity, term, share): the terms next to an entity that disclose more than ``GENERALISE`` of it; and
    (term, h1, h2): the texts with a term that may."""
    n = texts.select("h1", "h2").distinct().count()
    entities = (near.select("entity", "h1", "h2").distinct().groupBy("entity").agg(F.count("*").alias("ce"))
                .filter(F.col("ce") >= SUPPORT))
    both = (near.select("entity", "term", "h1", "h2").distinct().groupBy("entity", "term")
            .agg(F.count("*").alias("cet")).filter(F.col("cet") >= SUPPORT))
    # A term is in at least the texts that have it next to any entity: that alone rules out common words.
    seen = near.select("term", "h1", "h2").distinct().groupBy("term").agg(F.count("*").alias("seen"))

    def share(texts_with_term: str) -> Column:
        return (F.log2(F.lit(float(n)) * F.col("cet") / (F.col(texts_with_term) * F.col("ce")))
                / F.log2(F.lit(float(n)) / F.col("ce")))

    both = materialize(both.join(entities, "entity").join(seen, "term")
                       .filter((F.col("ce") < n) & (share("seen") > GENERALISE)), "pii-both")
    wanted = materialize(both.select("term").distinct(), "pii-terms")
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS))
    # At most BUCKETS rows, whatever the corpus.
    buckets = F.broadcast(wanted.select(bucket("term").alias("bucket")).distinct())
    words = (texts.select("h1", "h2", F.explode(F.array_distinct(F.transform(F.regexp_extract_all(
        "text", F.lit(WORD), F.lit(0)), F.lower))).alias("term"))
        .withColumn("bucket", bucket("term")).join(buckets, "bucket", "left_semi").select("term", "h1", "h2").distinct())
    words = materialize(words.join(wanted, "term", "left_semi"), "pii-words")
    counts = words.groupBy("term").agg(F.count("*").alias("ct"))
    share = (both.join(counts, "term").withColumn("share", share("ct")).filter(F.col("share") > GENERALISE)
             .select("entity", "term", "share"))
    return share, words


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(id, base, terms, sanitised, *carry) for every row of ``docs``.

    base and terms are arrays of spans (s, e, kind: code points, e exclusive); a term's kind is
    ``term`` if it is generalised and ``gone`` if it is removed.
    """
    rows = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry or [])]).alias("row"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(2), "text"))
    marked = rows.withColumn("base", base_spans(F.col("text")))

    # What texts hold and what stands next to it; texts that are equal stand for one.
    spans = materialize(marked.filter(F.size("base") > 0).select("h1", "h2", "base"), "pii-spans")
    near = materialize(spans.select("h1", "h2", F.explode(F.flatten(F.transform("base", lambda x: F.concat(
        terms("l", x), terms("r", x))))).alias("t")).select("h1", "h2", "t.*").distinct(), "pii-near")
    held = spans.select("h1", "h2", F.explode(F.transform("base", entity)).alias("entity")).distinct()
    share, words = disclosing(near, rows.select("text", "h1", "h2"))
    # A text with the entity loses the term wherever it stands, not only next to the entity.
    lost = materialize(words.join(materialize(share, "pii-share"), "term").join(held, ["h1", "h2", "entity"])
                       .groupBy("h1", "h2", "term").agg(F.max("share").alias("share")), "pii-lost")
    places = (rows.join(lost.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi")
              .select("h1", "h2", F.explode(found(F.col("text"), WORD, "term")).alias("w"))
              .select("h1", "h2", "w.s", "w.e", F.lower("w.m").alias("term")).distinct())
    cuts = (places.join(lost, ["h1", "h2", "term"])
            .withColumn("kind", F.when(F.col("share") > REMOVE, "gone").otherwise("term"))
            .groupBy(F.col("h1").alias("k1"), F.col("h2").alias("k2"))
            .agg(F.array_sort(F.collect_list(F.struct("s", "e", "kind"))).alias("terms")))
    cuts = materialize(cuts, "pii-cuts")
    slim = F.transform("base", lambda x: F.struct(x["s"], x["e"], x["kind"]))
    out = (marked.withColumn("base", slim)
           .join(cuts, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
           .withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<s:int,e:int,kind:string>>"))))
    return out.select(F.col("row.id").alias(id_col), "base", "terms",
                      masked(F.col("text"), ordered(F.concat("base", "terms"))).alias("sanitised"),
                      *[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(carry or [])])


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced; of spans that overlap the first one's mark stands for all."""
    mark = lambda x: F.when(x["kind"] == "gone", "").otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))

    def done(x: Column) -> Column:
        def piece(span: Column, i: Column) -> Column:
            p = F.when(i == 0, 0).otherwise(F.get(x["ends"], i - 1))
            return F.when(span["s"] >= p, F.concat(cut(x["parts"], p, span["s"] - p), mark(span))).otherwise("")

        last = F.element_at(x["ends"], -1)
        return F.concat(F.array_join(F.transform(x["spans"], piece), ""), cut(x["parts"], last, F.length(text) - last))

    whole = lambda y: let(F.struct(
        y.alias("spans"), blocks(text).alias("parts"),
        running(F.transform(y, lambda z: z["e"]), F.greatest, 0).alias("ends")), done)
    return let(spans, lambda y: F.when(F.size(y) > 0, whole(y)).otherwise(text))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")
