"""Toxicity, personal data, Order MinHash and the pipeline."""

import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import regex
import xxhash
from pyspark.sql import functions as F

from edge_docs import frame, prose, rows
from locus.llm import order_minhash, pii, toxicity
from locus.llm.queries import read

SF = "/root/testdata/sf0.1"


# --- toxicity

def test_held_out_accuracy(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model).join(labels, "doc_id").filter(toxicity.held_out(F.col("doc_id")))
    got = {(r["toxic"], r["p"]): r["n"] for r in out.groupBy("toxic", (F.col("score") >= 0.5).alias("p"))
           .agg(F.count("*").alias("n")).collect()}
    hit, miss, false = got.get((1, True), 0), got.get((1, False), 0), got.get((0, True), 0)
    assert hit / (hit + miss) > 0.85 and hit / (hit + false) > 0.9


def test_held_out_rows(spark):
    ids = [0, 1, 5, 17, 123456789, -4]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id BIGINT").select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h"))
    assert {r["doc_id"]: r["h"] for r in got.collect()} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}


def test_scores_of_awkward_rows(spark):
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(20)] + [(None, 1, 1), (5, 1, None)],
                                   "doc_id BIGINT, quality INT, toxic INT")
    df = frame(spark)
    out = toxicity.score(df, toxicity.train(df, labels), carry=["row", "id"]).collect()
    assert len(out) == len(rows()) and all(0 <= r["score"] <= 1 for r in out)
    by_text = {}
    for r in out:
        by_text.setdefault(r["text"] or "", set()).add(r["score"])
    assert all(len(s) == 1 for s in by_text.values())
    empty = frame(spark, [])
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0
    # Without labels the fixed list alone decides.
    alone = toxicity.train(df, labels.limit(0))
    two = frame(spark, [(1, "you idiot moron scum"), (2, "a calm and friendly note")])
    assert {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.score(two, alone).collect()} == {1: True, 2: False}


def test_label_model_finds_good_and_dependent_voters():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.15
    fire = lambda a, b: (rng.random(4000) < np.where(truth, a, b)).astype(int)
    good = [fire(0.7, 0.01) for _ in range(6)]
    noise = [fire(0.1, 0.1) for _ in range(3)]
    twin = np.where(rng.random(4000) < 0.95, noise[0], 1 - noise[0])  # copies a worthless voter
    votes = np.stack([*good, *noise, twin], axis=1)
    model = toxicity.LabelModel()
    post = model.fit(votes, np.ones(4000))
    assert ((post > 0.5) == truth).mean() > 0.98
    assert 9 in (model.parent[6], 9) and (model.parent[9] == 6 or model.parent[6] == 9)


# --- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def fine(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        luhn = sum(v - 9 if v > 9 else v for v in (int(c) * (1 + i % 2) for i, c in enumerate(d[::-1])))
        return 14 <= len(d) <= 19 and luhn % 10 == 0
    return 10 <= len(d) <= 15 if kind == "phone" else True


def brute_base(text):
    out = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if fine(k, m[0])]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


PIECES = ["a", "bob", "@", ".", "-", "x.com", "1", "12", "255", "256", "10.0.0.1", "4111 1111 1111 1111", "4111111111111111",
          "+1 (377) 555-0271", "+", " ", "é", "😀", "_", "(", "007.1.2.3.4", "a@b.c_d@e.f", "5500-0000-0000-0004", "\n", "%"]


def test_base_spans_against_brute_force(spark):
    rng = random.Random(12)
    pairs = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))) for i in range(1500)]
    pairs += [(9000, "7" * 30000 + " " + "a" * 30000 + "@"), (9001, "1 " * 20000), (9002, "+1" * 9000)] + rows()
    out = pii.sanitise(frame(spark, pairs)).select("doc_id", pii.listed(F.col("base")).alias("b"), "sanitised").collect()
    got = sorted(((r["doc_id"], r["b"]) for r in out), key=repr)
    assert got == sorted(((i, brute_base(t or "")) for i, t in pairs), key=repr)
    texts = {i: t for i, t in pairs if i is not None and i >= 9000 or i in range(100, 1500)}
    for r in out:
        if r["doc_id"] in texts and not r["b"]:
            assert r["sanitised"] == texts[r["doc_id"]]
    assert pii.sanitise(frame(spark, [])).count() == 0


def test_terms_that_disclose(spark):
    rng = random.Random(3)
    # "zanzibar" stands next to one address only, and nowhere else; "often" stands everywhere.
    pairs = [(i, f"{prose(rng, 8)} often zanzibar ann@mail.example.com often {prose(rng, 8)}") for i in range(6)]
    # "mostly" gives it away in most texts that have it, not in all.
    pairs += [(10 + i, f"{prose(rng, 5)} mostly bob@mail.example.com {prose(rng, 5)}") for i in range(30)]
    pairs += [(50 + i, f"{prose(rng, 12)} often {prose(rng, 3)} {'mostly' if i < 12 else ''}") for i in range(250)]
    # Copies count once, so a word of a copied text is no evidence.
    pairs += [(400 + i, "quokka carl@mail.example.com wombat") for i in range(9)]
    # Nor do copies without the address make a word common: "zanzibar" is in one more text, however often.
    pairs += [(500 + i, "plain zanzibar") for i in range(90)]
    out = {r["doc_id"]: r for r in pii.sanitise(frame(spark, pairs), carry=["h1", "row"]).collect()}
    assert "zanzibar" not in out[0]["sanitised"] and "[EMAIL]" in out[0]["sanitised"] and "often" in out[0]["sanitised"]
    assert [t["kind"] for t in out[0]["terms"]] == ["gone"]
    assert out[10]["sanitised"].count("[TERM]") == 1 and "mostly" not in out[10]["sanitised"]
    assert out[400]["terms"] == [] and out[400]["sanitised"] == "quokka [EMAIL] wombat"
    assert all(out[i]["sanitised"] == dict(pairs)[i] for i in range(50, 300))
    assert out[0]["h1"] == "clash"


def entities_of(text):
    """(place, end, entity) by plain patterns."""
    for k, p in PATTERNS.items():
        for m in re.finditer(p, text):
            if fine(k, m[0]):
                yield m.start(), m.end(), (k, re.sub("[^0-9]", "", m[0]) if k in ("card", "phone") else m[0].lower())


def brute_terms(texts):
    """The marked words of each text: shares over distinct texts, marks wherever a term stands beside its entity's text."""
    word = regex.compile(r"\p{L}{3,}")
    near, holds, has = {}, {}, {}
    for t in set(texts):
        for w in word.findall(t):
            has.setdefault(w.lower(), set()).add(t)
        for s, e, x in entities_of(t):
            holds.setdefault(x, set()).add(t)
            for w in word.finditer(t):
                if (s - pii.CONTEXT <= w.start() and w.end() <= s) or (e <= w.start() and w.end() <= e + pii.CONTEXT):
                    # A word that touches the edge of the window may go on beyond it.
                    if w.start() > s - pii.CONTEXT or w.start() == 0:
                        if w.end() < e + pii.CONTEXT or w.end() == len(t):
                            near.setdefault((x, w[0].lower()), set()).add(t)
    # An entity counts if it has a word beside it.
    n, beside = len(set(texts)), {}
    for (x, _), where in near.items():
        beside.setdefault(x, set()).update(where)
    shares = {}
    for (x, w), where in near.items():
        ce, cet = len(beside[x]), len(where)
        if ce >= pii.SUPPORT and cet >= pii.SUPPORT and ce < n:
            shares[x, w] = math.log2(n * cet / (len(has[w]) * ce)) / math.log2(n / ce)
    out = []
    for t in texts:
        lost = {}
        for (x, w), v in shares.items():
            if v > pii.GENERALISE and t in holds[x]:
                lost[w] = max(v, lost.get(w, 0))
        out.append([(m.start(), m.end(), "gone" if lost[m[0].lower()] > pii.REMOVE else "term")
                    for m in word.finditer(t) if m[0].lower() in lost])
    return out, shares


def test_marked_terms_against_brute_force(spark):
    rng = random.Random(31)
    people = ["ann@x.com", "Bob@Y.org", "4111 1111 1111 1111", "+1 (377) 555-0271", "10.1.2.3"]
    other = {"4111 1111 1111 1111": "4111-1111 11111111", "+1 (377) 555-0271": "+1 377-5550271", "Bob@Y.org": "bob@y.org"}
    names = [f"name{c}".replace("name", "Zeta") for c in "abcdefghijklmno"]
    texts = []
    for i in range(400):
        if i % 3:
            texts.append(f"{prose(rng, 14)} {' '.join(rng.sample(names, 1)) if rng.random() < 0.25 else ''} {prose(rng, 4)}")
            continue
        p = rng.randrange(len(people))
        own = [n.upper() if rng.random() < 0.2 else n for n in names[3 * p:3 * p + 3] if rng.random() < 0.6]
        who = other.get(people[p], people[p]) if rng.random() < 0.4 else people[p]
        far = f"{prose(rng, 20)} {rng.choice(own)}" if own and rng.random() < 0.5 else ""
        texts.append(f"{prose(rng, 6)} {' '.join(own)} {who}, {prose(rng, 6)} {far}")
    # Names of one person only, and in ever more texts without the person.
    for j, n in enumerate(["Omega", "Sigma", "Kappa", "Theta", "Lambda"]):
        texts += [f"{prose(rng, 5)} {n} eve{j}@z.net {prose(rng, 12)} {n} {prose(rng, 3)}" for _ in range(6)]
        texts += [f"{prose(rng, 9)} {n} {prose(rng, 9)}" for _ in range(4 * j)]
    texts += texts[:40]
    want, shares = brute_terms(texts)
    got = pii.sanitise(frame(spark, list(enumerate(texts)))).select("doc_id", "terms").collect()
    assert {r["doc_id"]: [tuple(x) for x in r["terms"]] for r in got} == dict(enumerate(want))
    kinds = [k for w in want for _, _, k in w]
    assert kinds.count("gone") > 20 and kinds.count("term") > 5
    assert sum(0.5 < v <= pii.GENERALISE for v in shares.values()) >= 2


def test_context_goes_past_other_matches(spark):
    # Plain numbers and neighbours of the same kind don't shorten the context.
    rng = random.Random(8)
    pairs = [(i, f"{prose(rng, 12)} card 4111 1111 1111 1111, exp 12/27, holder Zanzibar {prose(rng, 12)}") for i in range(6)]
    pairs += [(10 + i, f"{prose(rng, 12)} Xylophon: ann{i}@x.com, bob@x.com {prose(rng, 12)}") for i in range(6)]
    pairs += [(50 + i, prose(rng, 20)) for i in range(250)]
    out = {r["doc_id"]: r["sanitised"] for r in pii.sanitise(frame(spark, pairs)).collect()}
    assert all("Zanzibar" not in out[i] and "[CARD]" in out[i] for i in range(6))
    assert all("Xylophon" not in out[10 + i] and out[10 + i].count("[EMAIL]") == 2 for i in range(6))


def test_marks_against_brute_force(spark):
    # Spans that overlap, touch and stand at both ends, in texts longer than several blocks.
    rng = random.Random(21)
    rows_, want = [], {}
    for i in range(150):
        n = rng.choice([0, 1, 255, 256, 257, 700, 3000])
        text = "".join(rng.choice("aé😀 \n0") for _ in range(n))
        spans = sorted({(s, min(n, s + rng.randint(1, 300)), rng.choice(["email", "gone"])) for s in
                        (rng.randint(0, max(n - 1, 0)) for _ in range(rng.choice([0, 1, 2, 9, 40])))}) if n else []
        out, p = "", 0
        for s, e, k in spans:
            if s >= p:
                out += text[p:s] + ("" if k == "gone" else "[EMAIL]")
            p = max(p, e)
        want[i] = out + text[p:]
        rows_.append((i, text, spans))
    df = spark.createDataFrame(rows_, "i int, t string, x array<struct<s:int,e:int,kind:string>>")
    assert {r["i"]: r["m"] for r in df.select("i", pii.masked(F.col("t"), F.col("x")).alias("m")).collect()} == want


def test_running_sums(spark):
    rows_ = [(list(range(n)),) for n in (0, 1, 2, 3, 4, 5, 8, 9, 10, 99, 100, 101)]
    df = spark.createDataFrame(rows_, "v array<int>").select("v", pii.running(F.col("v"), pii.added, 0).alias("s"))
    assert all(r["s"] == [i * (i + 1) // 2 for i in r["v"]] for r in df.collect())


def test_a_text_of_many_numbers_takes_no_longer_a_byte(spark):
    text = "".join(f"{i % 9973} a{i}@b.cd " for i in range(70_000))  # 1.1 MB, 140,000 matches
    start = time.monotonic()
    r = pii.sanitise(frame(spark, [(1, text)])).select(F.size("base").alias("n"), F.length("sanitised").alias("l")).first()
    assert r["n"] == 70_000 and time.monotonic() - start < 60  # appending to one array grows with its square
    assert r["l"] == len(re.sub(PATTERNS["email"], "[EMAIL]", text))


# --- Order MinHash

def xx(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def long(x):
    return (x & (1 << 64) - 1).to_bytes(8, "little")


def brute_signature(text):
    words = re.findall(r"[^\x20\x09-\x0D]{1,%d}" % order_minhash.RUN, text)
    elements, seen = [], {}
    for p in range(max(len(words) - order_minhash.K + 1, 1) if words else 0):
        h = 42
        for w in words[p:p + order_minhash.K]:
            h = xx(w.encode(), h)
        seen[h] = seen.get(h, -1) + 1
        element = xx(seen[h].to_bytes(4, "little"), xx(long(h)))
        elements.append((element, p))
    out = []
    for b in range(order_minhash.BINS):
        # Least as signed numbers, which is how arrays of longs are sorted.
        least = sorted((e - (1 << 64) if e >> 63 else e, p) for e, p in elements if e >> (64 - order_minhash.BIN_BITS) == b)[:order_minhash.KEPT]
        if least:
            h = 42
            for _, e in sorted((p, e) for e, p in least):
                h = xx(long(e), h)
            out.append(f"{b << 32 - order_minhash.BIN_BITS | h >> 32 + order_minhash.BIN_BITS:08x}")
    return "".join(sorted(out))


def brute_likeness(a, b):
    words = lambda s: [int(s[i:i + 8], 16) for i in range(0, len(s), 8)]
    cut = lambda s: {x >> 32 - order_minhash.BIN_BITS: x for x in words(s)}
    a, b = cut(a), cut(b)
    return sum(a.get(k) == b.get(k) for k in a | b) / len(a | b) if a | b else 1.0


def test_order_minhash_against_brute_force(spark):
    pairs = rows()
    got = order_minhash.fingerprints(frame(spark)).collect()
    assert len(got) == len(pairs)
    prints = {}
    for r in got:
        prints.setdefault((r["doc_id"], r["n_chars"]), set()).add(r["fingerprint"])
    for i, t in pairs:
        assert brute_signature(t or "") in prints[i, len(t or "")]
    # Where ids and texts are one to one, the next document is the next smaller id.
    single = [(i, t or "") for i, t in pairs if i is not None and i > 3 and i not in (7, 15)]
    df = frame(spark, single)
    order = sorted(single, reverse=True)
    for r in order_minhash.fingerprints(df).collect():
        k = [i for i, _ in order].index(r["doc_id"])
        text, following = order[k][1], order[(k + 1) % len(order)][1]
        n = len(text) // 3
        edited = text[:len(text) - n] + following[:n]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["edited_fingerprint"] == brute_signature(edited)
        assert math.isclose(r["near_edited"], brute_likeness(brute_signature(text), brute_signature(edited)))
        assert math.isclose(r["near_next"], brute_likeness(brute_signature(text), brute_signature(following)))
    assert order_minhash.fingerprints(frame(spark, [])).count() == 0


def test_likeness_sees_order():
    rng = random.Random(5)
    words = prose(rng, 600).split()
    cut = words[300:] + words[:300]
    turned = [w for i in range(0, 600, 4) for w in words[i:i + 4][::-1]]
    base = brute_signature(" ".join(words))
    assert brute_likeness(base, brute_signature(" ".join(words[:590]))) > brute_likeness(base, brute_signature(" ".join(cut)))
    assert brute_likeness(base, brute_signature(" ".join(turned))) < 0.05


# --- pipeline

def test_pipeline_stages_hand_on_documents(spark, tmp_path):
    import corpus_pipeline

    frame(spark).coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i == 4)) for i in range(9)], "doc_id BIGINT, quality INT, toxic INT") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, n = docs.columns, docs.count()
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        assert len(kept[name]) <= n
        n = len(kept[name])
    lines = {(r["doc_id"], r["n_chars"], r["text"]) for r in kept["line_dedup"]}
    assert all(len(t) == c and "same license" not in t.lower() for _, c, t in lines)
    assert len(kept["pii"]) == len(kept["simhash"]) < len(kept["line_dedup"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in whole.collect()} == {r["doc_id"] for r in kept["pii"]}


def test_pipeline_keeps_columns_whatever_their_names(spark, tmp_path):
    import corpus_pipeline

    extra = ["score", "kept", "sanitised", "base", "terms", "_text_hash", "_hash", "_id", "a.b", "component", "root", "document_rest", "c0"]
    docs = frame(spark).withColumns({f"x{i}": F.lit(i) for i in range(len(extra))}).withColumnsRenamed(
        {f"x{i}": c for i, c in enumerate(extra)})
    spark.createDataFrame([(i, 1, int(i == 4)) for i in range(9)], "doc_id BIGINT, quality INT, toxic INT") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert docs.columns == columns
            docs.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            for i, c in enumerate(extra):
                assert {r[0] for r in docs.select(F.col(f"`{c}`")).distinct().collect()} == {i}
            assert docs.filter("n_chars <> length(text)").isEmpty()
    assert docs.count() > 0


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
