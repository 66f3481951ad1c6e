"""The filter audit against a brute-force run of every order."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from edge_docs import frame, prose, rows
from locus.llm import filter_audit
from locus.llm.text_trie import TextTrie, shared

CLASHES = ["part", "mask", "n", "weight", "head", "prefix", "heavy", "labelled", "good", "toxic", "quality", "all", "cells", "a.b"]


def brute(docs, labels):
    """docs: (id, text, source); labels: (id, quality, toxic)."""
    fails = []
    for i, text, _ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                      "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                      "E": any((o or "") == t and j is not None and (i is None or j < i) for j, o, _ in docs)})
    has = lambda i, c: any(x[0] == i and x[c] == 1 for x in labels if i is not None)
    out = {}
    for part in {s or "" for _, _, s in docs}:
        mine = [(i, f) for (i, _, s), f in zip(docs, fails) if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [(i, x) for i, x in left if x[f]]
                kept = [(i, x) for i, x in left if not x[f]]
                earlier = sum(x[f] for i, x in mine) - len(gone)
                alone = sum(x[f] and sum(x.values()) == 1 for _, x in mine)
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(kept), len(gone), earlier, alone, sum(has(i, 1) for i, _ in gone),
                                                   sum(has(i, 2) for i, _ in gone)]
                left = kept
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def sources(i, n):
    return [None, "", "a", "b"][(n if i is None else i) % 4]


def tables(spark, pairs, label_rows):
    docs = [(i, t, sources(i, n)) for n, (i, t) in enumerate(pairs)]
    df = spark.createDataFrame([(*d, *["x"] * len(CLASHES)) for d in docs],
                               "doc_id bigint, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES))
    return docs, df, spark.createDataFrame(label_rows, "doc_id bigint, quality int, toxic int")


def measured(df):
    return {(r[0], r[1], r[2]): list(r)[3:] for r in df.collect()}


def varied():
    rng = random.Random(6)
    long = prose(rng, 260)
    out = rows() + [(50 + i, long + "tail" * i) for i in range(6)] + [(60 + i, long) for i in range(9)]
    out += [(80, long.upper()), (81, long + " $"), (82, "one two " * 150), (83, long.upper() + " #"), (84, long.upper()),
            (None, long), (None, long), (61, long), (90, "É" * 60 + "AB")]
    return out


LABELS = [(i, i % 2, (i + 1) % 3 == 0) for i in range(0, 90, 2)] + [(50, 1, 1), (61, 0, 1), (61, 1, 0), (None, 1, 1), (64, None, 1)]
LABELS = [(i, q, None if t is None else int(t)) for i, q, t in LABELS]


@pytest.mark.parametrize("sizes", [(16 << 20, 32 << 20, 16), (3000, 4000, 2)])
def test_every_order_equals_brute_force(spark, monkeypatch, sizes):
    # With small sizes: several tries in a task, prefixes made longer, many ranges.
    for name, size in zip(("LOCAL_BYTES", "TRIE_BYTES", "HEAD"), sizes):
        monkeypatch.setattr(filter_audit, name, size)
    monkeypatch.setattr(filter_audit.with_prefixes, "__defaults__", (sizes[2], sizes[1]))
    docs, df, labels = tables(spark, varied(), LABELS)
    assert measured(filter_audit.audit(df.repartition(3), labels)) == brute(docs, LABELS)


def test_prefixes_get_longer_until_they_are_light_or_whole(spark):
    base = "p" * 100
    texts = [base + c * 5 for c in "abcdefgh" for _ in range(3)] + ["short", ""] + ["whole" * 30] * 40
    rows = spark.createDataFrame([(t.encode(), t[:4], len(t) + 300) for t in texts], "text binary, head string, weight int")
    out = filter_audit.with_prefixes(rows, 4, 2000).collect()
    weight = {}
    for r in out:
        assert r.text.decode().startswith(r.prefix)
        weight[r.prefix] = weight.get(r.prefix, 0) + r.weight
    assert len(out) == len(texts)
    assert all(w <= 2000 or len(p) == 150 for p, w in weight.items())
    assert {r.prefix for r in out if r.text.startswith(b"ppp")} == {base + c * 5 for c in "abcdefgh"}


def test_trie_holds_every_text_with_its_least_id():
    rng = random.Random(8)
    trie, want = TextTrie(), {}
    for i in range(3000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12)))
        key = rng.choice([None, rng.randrange(1000)])
        trie.add(text, key, (i,))
        want.setdefault(text, []).append((key, i))
    got = {t: (least, sorted(rows, key=repr)) for t, least, rows in trie.walk()}
    assert got == {t: (min((k for k, _ in r if k is not None), default=None), sorted(r, key=repr)) for t, r in want.items()}
    # Compressed: no node but the root has one kid and no text of its own.
    stack = [*trie.root.kids.values()]
    while stack:
        node = stack.pop()
        assert node.ends or len(node.kids) > 1
        stack += node.kids.values()
    assert shared(b"abcdef", b"xxabcdzz", 2) == 4


def test_a_task_sends_one_text_of_a_group_of_copies(spark):
    df = frame(spark, [(i, "the same text") for i in range(500)]).coalesce(1)
    rows = filter_audit.rows_of(df, "doc_id", "text", "source").mapInArrow(
        filter_audit.local_tries, "id bigint, part string, mask int, n bigint, text binary")
    assert rows.filter("text IS NOT NULL").count() == 1
    assert rows.agg(F.sum("n")).first()[0] == 500


def test_empty_tables(spark):
    docs, df, labels = tables(spark, [], [])
    assert filter_audit.audit(df, labels).count() == 0
    docs, df, labels = tables(spark, [(1, None), (2, "")], [])
    assert measured(filter_audit.audit(df, labels)) == brute(docs, [])
