"""Importance resampling against a brute-force version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from edge_docs import frame, prose, rows
from locus.llm import importance

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHES = ["n_words", "n_features", "buckets", "counts", "weight", "score", "rank", "_down", "_last", "a.b", "_mid", "_part"]


def counted(text, runs, buckets):
    words = WORDS.findall((text or "").translate(LOWER))
    features = [" ".join(words[i:i + r]) for r in range(1, runs + 1) for i in range(len(words) - r + 1)]
    return len(words), Counter(zlib.crc32(f.encode()) % buckets for f in features)


def brute(docs, target, runs=3, buckets=10_000, min_words=20, percent=5, seed=42):
    found = [(i, *counted(t, runs, buckets)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, c in found:
        s.update(c)
    for x in target:
        t.update(counted(x, runs, buckets)[1])
    n_s, n_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * n_s / ((s[b] + 1) * n_t)))
    out = []
    for i, words, c in found:
        weight = sum(gain(b) * n for b, n in c.items())
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((words, (i, sum(c.values()), weight, score)))
    able = sorted((r for w, r in out if w >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = able[:percent * len(able) // 100]
    rest = able[len(drawn):] + [r for w, r in out if w < min_words]
    return sorted([(*r, k) for k, r in enumerate(drawn, 1)] + [(*r, None) for r in rest], key=repr)


def taken(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def target_frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id bigint, text string")


def test_crc_matrices_equal_zlib():
    rng = random.Random(3)
    words = [bytes(rng.randrange(33, 256) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    runs = np.array([[rng.randrange(300) for _ in range(3)] for _ in range(500)])
    want = [zlib.crc32(b" ".join(words[i] for i in run)) for run in runs]
    assert importance.crc_of_runs(words, runs).tolist() == want
    assert importance.crc_columns(np.zeros((2, 0), np.uint8)).tolist() == [0, 0]


def test_small_groups_and_pieces_count_the_same(monkeypatch):
    texts = [None if t is None else t.encode() for _, t in rows()]
    plain = [(w, n, b.tolist(), c.tolist()) for w, n, b, c in importance.bucket_counts(iter(texts), 3, 10_000)]
    monkeypatch.setattr(importance, "GROUP", 200)
    monkeypatch.setattr(importance, "PIECE", 30)
    assert [(w, n, b.tolist(), c.tolist()) for w, n, b, c in importance.bucket_counts(iter(texts), 3, 10_000)] == plain
    for (_, t), (w, n, b, c) in zip(rows(), plain):
        words, want = counted(t, 3, 10_000)
        assert (w, n, dict(zip(b, c))) == (words, sum(want.values()), dict(want))


def test_draw_equals_brute_force_on_awkward_rows(spark):
    rng = random.Random(9)
    target = [prose(rng, 40) for _ in range(6)] + [None, "", rows()[12][1]]
    docs = rows() + [(100 + i, prose(rng, 25)) for i in range(40)]
    df = frame(spark, docs).withColumns({c: F.lit("clash") for c in CLASHES}).repartition(5)
    assert taken(importance.resample(df, target_frame(spark, target))) == brute(docs, target)
    args = {"runs": 2, "buckets": 64, "min_words": 5, "percent": 40, "seed": 7}
    assert taken(importance.resample(df, target_frame(spark, target), **args)) == brute(docs, target, **args)


def test_the_target_is_preferred(spark):
    rng = random.Random(2)
    docs = [(i, prose(rng, 60)) for i in range(80)]
    target = [" ".join(rng.sample(docs[i][1].split(), 50)) for i in range(8)]
    out = importance.resample(frame(spark, docs), target_frame(spark, target), percent=10).collect()
    assert {r.doc_id for r in sorted(out, key=lambda r: -r.weight)[:8]} == set(range(8))
    # The noise may let in a few others.
    drawn = {r.doc_id for r in out if r.rank is not None}
    assert len(drawn) == 8 and len(drawn & set(range(8))) >= 6


def test_empty_tables(spark):
    some = [(i, "a word " * 12) for i in range(25)]
    assert importance.resample(frame(spark, []), target_frame(spark, ["a b c"])).count() == 0
    assert taken(importance.resample(frame(spark, some), target_frame(spark, []))) == brute(some, [])
