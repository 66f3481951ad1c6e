"""SimHash, line, substring and embedding deduplication against brute force."""

import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from edge_docs import frame, prose, rows
from locus.llm import embedding_dedup, line_dedup, simhash, substring_dedup
from locus.llm.cuckoo import CuckooFilter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def groups(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- SimHash

def brute_fingerprint(text, k):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lower)
    grams = [" ".join(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_on_awkward_rows(spark):
    pairs = rows()
    fps = [brute_fingerprint(t, 3) for _, t in pairs]
    near = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    root = groups(len(fps), near)
    least = {}
    for (i, _), r in zip(pairs, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted(((i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(pairs, fps, root)), key=repr)
    out = simhash.near_duplicates(frame(spark), 3, 3)
    got = sorted(map(tuple, out.select("doc_id", simhash.hex_fingerprint(F.col("fp")), "component").collect()), key=repr)
    assert got == want
    kept = simhash.representatives(frame(spark), 3, 3)
    assert kept.columns == frame(spark).columns
    assert kept.count() == len(set(root))
    assert simhash.near_duplicates(frame(spark, []), 3, 3).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_pair_within_the_radius_collides(radius):
    rng = random.Random(radius)
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        bits = rng.sample(range(64), radius)
        assert any(all(not m >> b & 1 for b in bits) for m in masks)


@pytest.mark.parametrize("bucket", [4096, 8])
def test_links_connect_what_brute_force_connects(spark, bucket):
    # Tight clusters: with a small bucket bound they are hashed again and compared in blocks.
    rng = random.Random(4)
    fps = set()
    for _ in range(8):
        seed = rng.getrandbits(64)
        for _ in range(25):
            fps.add(seed ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    fps = sorted(fps)
    root = groups(len(fps), [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp BIGINT")
    at = {simhash.signed(f): i for i, f in enumerate(fps)}
    edges = [(at[r["src"]], at[r["dst"]]) for r in simhash.links(df, 3, bucket).collect()]
    assert groups(len(fps), edges) == root


# --- lines

def brute_lines(pairs, min_docs):
    strip = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    docs = [(i, (t or "").split("\n")) for i, t in pairs]
    count = {}
    for _, lines in docs:
        for k in {strip(x) for x in lines}:
            count[k] = count.get(k, 0) + 1
    out = []
    for i, lines in docs:
        kept = [x for x in lines if not strip(x) or count[strip(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines_on_awkward_rows(spark):
    df = frame(spark)
    index = line_dedup.LineIndex(spark, 1).insert(df)
    out = index.drop(df, 10, carry=["row", "h1"])
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept", "row", "h1"]
    got = sorted((tuple(r)[:4] for r in out.collect()), key=repr)
    assert got == brute_lines(rows(), 10) and any(r[2] for r in got)
    empty = frame(spark, [])
    assert line_dedup.LineIndex(spark, 1).insert(empty).drop(empty, 10).count() == 0


def test_deletion_gives_the_index_back(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 16)  # several shards, dealt anew as keys are added
    a, b = rows()[:20], rows()[20:]
    one = line_dedup.LineIndex(spark, 1).insert(frame(spark, a))
    two = one.insert(frame(spark, b))
    counts = lambda x: sorted(map(tuple, x.counts.collect()))
    assert counts(two) == counts(line_dedup.LineIndex(spark, 1).insert(frame(spark, rows())))
    assert counts(two.delete(frame(spark, b))) == counts(one)
    assert counts(two.delete(frame(spark, rows()))) == []
    # No filter forgets a key that the exact table has.
    filters = {r["shard"]: CuckooFilter.from_bytes(bytes(r["filter"])) for r in two.filters.collect()}
    for h1, h2, _ in counts(two):
        assert filters[h1 % two.shards].contains(np.array([h1]), np.array([h2])).all()


def test_cuckoo_filter_inserts_and_removes():
    rng = np.random.default_rng(3)
    h1, h2 = rng.integers(-2 ** 62, 2 ** 62, (2, 5000))
    f = CuckooFilter.of(h1[:3000], h2[:3000])
    assert f.contains(h1[:3000], h2[:3000]).all()
    assert f.contains(h1[3000:], h2[3000:]).mean() < 0.01
    f.remove(h1[:1000], h2[:1000])
    assert f.contains(h1[1000:3000], h2[1000:3000]).all()
    assert f.contains(h1[:1000], h2[:1000]).mean() < 0.01
    f.remove(h1[1000:3000], h2[1000:3000])
    assert not f.table.any()


# --- substrings

def brute_substrings(pairs, n):
    docs = [(i, WORDS.findall(t or "")) for i, t in pairs]
    order = lambda i: math.inf if i is None else i
    first = {}
    for i, w in docs:
        for s in range(len(w) - n + 1):
            k = tuple(w[s:s + n])
            first[k] = min(first.get(k, math.inf), order(i))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            if first[tuple(w[s:s + n])] < order(i):
                gone[s:s + n] = [True] * n
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [50, 7, 1])
def test_substrings_on_awkward_rows(spark, n):
    got = sorted(map(tuple, substring_dedup.dedup(frame(spark), n).collect()), key=repr)
    assert got == brute_substrings(rows(), n) and any(r[2] for r in got)


def test_substrings_that_overlap_and_repeat(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(4)]
    pairs = [(rng.randint(0, 30), " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for _ in range(40)]
    pairs += [(50, "z " * 300), (51, "z " * 120 + "y " + "z " * 9)]
    got = sorted(map(tuple, substring_dedup.dedup(frame(spark, pairs), 6).collect()), key=repr)
    assert got == brute_substrings(pairs, 6)
    assert substring_dedup.dedup(frame(spark, []), 6).count() == 0


def test_lists_of_a_repeated_id_are_bounded(spark):
    # Many rows without an id share a passage: no value may hold the lists of all of them.
    rng = random.Random(6)
    passage = prose(rng, 12)
    pairs = [(1, passage)] + [(None, f"{prose(rng, 5)} {passage} {prose(rng, 5)}") for _ in range(40)]
    pairs += [(None, f"head {passage} tail")] * 30
    df = frame(spark, pairs).select(F.coalesce("doc_id", F.lit(substring_dedup.LAST)).alias("o"), F.xxhash64("text").alias("t"), "text")
    cuts = substring_dedup.repeated_windows(df, 6).collect()
    assert len(cuts) == 41 and all(len(r["windows"]) <= 7 for r in cuts)
    got = sorted(map(tuple, substring_dedup.dedup(frame(spark, pairs), 6).collect()), key=repr)
    assert got == brute_substrings(pairs, 6)


# --- embeddings

def brute_vectors(data, threshold):
    ok = [i for i, (_, v) in enumerate(data) if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = [(a, b) for a in ok for b in ok if b < a and len(data[a][1]) == len(data[b][1])
             and np.dot(data[a][1], data[b][1]) / np.linalg.norm(data[a][1]) / np.linalg.norm(data[b][1]) >= threshold]
    n = [0] * len(data)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    root = groups(len(data), links)
    least = {}
    for (i, _), r in zip(data, root):
        least[r] = min(i, least.get(r, i))
    return sorted(((i, m, least[r]) for (i, _), m, r in zip(data, n, root)), key=repr)


def vectors(rng, spread):
    out = []
    for _ in range(12):
        center = rng.normal(size=8)
        out += [(center + spread * rng.normal(size=8)).tolist() for _ in range(rng.integers(1, 25))]
    return out


@pytest.mark.parametrize("spread, fold", [(0.01, 2048), (0.12, 2048), (0.12, 8), (0.3, 8)])
def test_vectors_against_brute_force(spark, monkeypatch, spread, fold):
    # Tight, loose and very loose groups; with small folding blocks classes meet in many pieces.
    monkeypatch.setattr(embedding_dedup, "FOLD", fold)
    vecs = vectors(np.random.default_rng(int(spread * 100)), spread)
    vecs += [vecs[0], vecs[0], [2 * x for x in vecs[3]], None, [0.0] * 8, [float("nan")] * 8, [1.0, None] + [0.0] * 6,
             [float("inf")] + [1.0] * 7, [1.0, 2.0], [1.0, 2.0], [], [1e-200] * 8, [1e200] * 8]
    data = [(i, v) for i, v in enumerate(vecs)]
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in data], "vec_id BIGINT, embedding ARRAY<DOUBLE>, node STRING, h1 INT")
    scaled = [(i, None if v is None else v if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v)
               else (np.array(v) / max(map(abs, v))).tolist()) for i, v in data]
    got = sorted(map(tuple, embedding_dedup.near_duplicates(df, 0.95).collect()), key=repr)
    assert got == brute_vectors(scaled, 0.95)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    assert embedding_dedup.near_duplicates(df, 0.95).count() == 0
    one = spark.createDataFrame([(4, [1.0, 2.0])], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    assert [tuple(r) for r in embedding_dedup.near_duplicates(one, 0.95).collect()] == [(4, 0, 4)]


def test_rare_links_are_found(spark):
    # Links between leaders are rare, so that a small sample has next to none.
    rng = np.random.default_rng(9)
    vecs = rng.normal(size=(6000, 64))
    vecs /= np.linalg.norm(vecs, axis=1)[:, None]
    for i in range(0, 200, 2):
        away = rng.normal(size=64)
        away -= away @ vecs[i] * vecs[i]
        cos = rng.uniform(0.951, 0.975)
        vecs[i + 1] = cos * vecs[i] + math.sqrt(1 - cos * cos) * away / np.linalg.norm(away)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    true = sum(n for _, n, _ in ((i, int((vecs @ v >= 0.95).sum()) - 1, 0) for i, v in enumerate(vecs)))
    got = embedding_dedup.near_duplicates(df, 0.95).agg(F.sum("n_links")).first()[0]
    assert true >= 200 and got >= 0.98 * true
