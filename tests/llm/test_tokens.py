"""Token counts, byte-level BPE and packing against the tokenizers' own libraries."""

import base64
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as vocab
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edge_docs import frame, rows
from locus.llm import byte_bpe, packing, token_counts

WORD_FILE, JSON, RANKS = (vocab.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))
BITS = ["a", "ab", "the", "'", "'re", "'s", "'ll", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "é", "1", "２",
        "!", "!!", "İ", "Σ", "ß", "日本", "한", "<|endoftext|>", "<|startoftext|>", "<|STARTOFTEXT|>", "ing", "😀", "ﬁ", "‍",
        "\x00", "\U0003d000", "\u1c89"]
TEXTS = st.lists(st.sampled_from(BITS) | st.characters(exclude_categories=["Cs"]), max_size=25).map("".join)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD_FILE)


@pytest.fixture(scope="module")
def ranks_library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=TEXTS)
def test_transducer_counts_as_the_library(text):
    t = token_counts.transducer(WORD_FILE)
    want = len(LIB.encode(text, add_special_tokens=False).ids)
    # However the text is cut into chunks.
    assert t.text(text)[-1] == t.text(text, 1)[-1] == t.text(text, 4)[-1] == want


LIB = Tokenizer.from_file(WORD_FILE)


@settings(max_examples=150, deadline=None)
@given(parts=st.lists(TEXTS.filter(lambda x: not any(s in x for s in ("<|",))), min_size=1, max_size=6))
def test_state_maps_compose_to_the_run_over_the_whole(parts):
    t = token_counts.transducer(WORD_FILE)
    parts = [p for p in parts if p and token_counts.starts(p[0])]
    maps = [token_counts.StateMap(lambda s, p=p: t.advance(s, p, False)) for p in parts]
    entries = [token_counts.REST] + [t.advance(token_counts.REST, x, False)[0] for x in ("ab", "!", "'", "x'r", "1'l", "'ve", "日")]
    for i, scanned in enumerate(token_counts.prefix_scan(maps)):
        for entry in entries:
            state, n = entry, 0
            for m in maps[:i + 1]:
                state, more = m(state)
                n += more
            assert scanned(entry) == (state, n)
    for entry, before in zip(entries, ("", "ab", "!", "'", "x'r", "1'l", "'ve", "日")):
        whole = "".join(parts)
        state, n = t.advance(entry, whole, True)
        assert state == token_counts.REST
        if not whole or token_counts.starts(whole[0]):
            n += t.advance(token_counts.REST, before, False)[1]
            assert n == len(LIB.encode(before + whole, add_special_tokens=False).ids)


def test_prefix_scan_has_every_prefix():
    t = token_counts.transducer(WORD_FILE)
    text = "It's a long-ish text, with   spaces\nand lines. " * 7
    for size in (5, 48, 100):
        ends = [*range(size, len(text), size), len(text)]
        got = t.prefixes(text, size)
        assert len(got) == len(ends) and got[-1] == len(LIB.encode(text, add_special_tokens=False).ids)
        for end, n in zip(ends, got):
            if text[end - 1].isspace():  # no word is open there
                assert n == len(LIB.encode(text[:end], add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ["a" * 5000, "ha" * 3000 + "!" * 999, "é" * 2000, "日本語" * 900, "ACGT" * 1500 + "'s",
                                  "x'" * 1200, "=" * 4097 + "'ll", "e\u0301" * 1500, "0123456789abcdef" * 300, "\u0301" * 700 + "z"])
def test_unbroken_texts_whose_entry_states_differ(text):
    """Periodic texts lead each chunk to another place of the period than its first guess."""
    t = token_counts.Transducer(WORD_FILE)
    want = len(LIB.encode(text, add_special_tokens=False).ids)
    for size in (7, 64, 301, 1024):
        assert t.text(text, size)[-1] == want


def test_a_state_map_does_not_grow_with_its_chunk():
    t = token_counts.Transducer(WORD_FILE)
    for text in ("a" * 40_000, "abcde" * 8000, "!a" * 20_000):
        sizes = []
        for chunk in (1000, 10_000):
            maps = [token_counts.StateMap(lambda s, i=i: t.advance(s, text[i:i + chunk], False)) for i in range(0, len(text), chunk)]
            for i, m in enumerate(maps):
                m(t.advance(token_counts.REST, text[max(0, i * chunk - token_counts.LOOKBACK):i * chunk], False)[0])
            token_counts.prefix_scan(maps)[-1](token_counts.REST)
            sizes.append(max(len(m.table) for m in maps))
        assert max(sizes) <= 32


def test_a_worker_forgets_states_between_texts(monkeypatch):
    monkeypatch.setattr(token_counts, "STATES", 50)
    t = token_counts.Transducer(WORD_FILE)
    for i in range(30):
        text = f"word{i} unusualness{chr(97 + i % 26) * 9} zyx"
        assert t.text(text)[-1] == len(LIB.encode(text, add_special_tokens=False).ids)
    assert len(t.states) < 200


def test_long_text_without_white_space_stays_small():
    t = token_counts.Transducer(WORD_FILE)
    text = "abc1+" * 400_000
    each = sum(map(t.count, ("abc", "1", "+")))
    tracemalloc.start()
    try:
        assert t.text(text)[-1] == 400_000 * each
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 4 * len(text) and text not in t.memo


def test_token_counts_on_awkward_rows(spark, word_library):
    out = token_counts.token_counts(frame(spark), WORD_FILE, 2048)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit", "chunk_tokens"]
    assert out.filter("element_at(chunk_tokens, -1) <> n_tokens").count() == 0
    got = sorted((tuple(r)[:4] for r in out.collect()), key=repr)
    want = []
    for i, t in rows():
        n = len(word_library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=repr)
    assert token_counts.token_counts(frame(spark, []), WORD_FILE, 2048).count() == 0


@settings(max_examples=200, deadline=None)
@given(text=TEXTS, chunk=st.integers(1, 9), overlap=st.integers(5, 9))
def test_stitched_pre_tokens_are_the_whole_texts(text, chunk, overlap):
    pattern = regex.compile(vocab.PATTERN)
    assert byte_bpe.pre_tokens(text, pattern, chunk, overlap) == pattern.findall(text)


def test_a_run_longer_than_the_overlap():
    pattern = regex.compile(vocab.PATTERN)
    for text in ("a" * 5000 + " b", " " * 4000 + "x", "1" * 700 + "'re" * 900, "!" * 3000 + "'s" * 50):
        assert byte_bpe.pre_tokens(text, pattern, 100, 20) == pattern.findall(text)


def test_merges_by_list_and_by_heap_agree(ranks_library):
    rng = random.Random(2)
    own = byte_bpe.ByteBpe(RANKS, vocab.PATTERN)
    for _ in range(300):
        data = "".join(rng.choice("etaoin shrdlu") for _ in range(rng.randint(1, 60))).encode()
        assert own.merge(data) == own.merge_long(data) == ranks_library._encode_single_piece(data)
    long = b"abracadabra" * 400
    assert own.merge(long) == ranks_library._encode_single_piece(long)


def test_encode_and_decode_on_awkward_rows(spark, ranks_library):
    tokens = byte_bpe.encode(frame(spark), RANKS, vocab.PATTERN)
    out = byte_bpe.decode(tokens, RANKS, vocab.PATTERN)
    got = sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in out.collect()), key=repr)
    want = [(i, ranks_library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows()]
    assert got == sorted(want, key=repr)
    assert byte_bpe.decode(byte_bpe.encode(frame(spark, []), RANKS, vocab.PATTERN), RANKS, vocab.PATTERN).count() == 0


@settings(max_examples=200, deadline=None)
@given(text=TEXTS, chunk=st.integers(2, 12))
def test_whole_texts_encode_as_the_library(text, chunk):
    ids = np.frombuffer(byte_bpe.codec(JSON, vocab.PATTERN, True).encode_whole(text, chunk), "<u4").tolist()
    assert ids == JSON_LIB.encode(text, add_special_tokens=False).ids


def test_whole_long_texts_encode_as_the_library():
    rng = random.Random(17)
    words = "".join(rng.choice(["the", " of", " ", "  ", "\n", "it's", "é", "12", "!?", " x"]) for _ in range(60_000))
    for text in (words, "ab" * 50_000, "a b " + " " * 70_000 + "x y", "z" * 40_000 + " end " + words[:50_000], "\n" * 40_000):
        ids = np.frombuffer(byte_bpe.codec(JSON, vocab.PATTERN, True).encode_whole(text), "<u4").tolist()
        assert ids == JSON_LIB.encode(text, add_special_tokens=False).ids


JSON_LIB = Tokenizer.from_file(JSON)


def library_pieces(pairs, capacity):
    out = []
    for i, t in pairs:
        ids = JSON_LIB.encode(t or "", add_special_tokens=False).ids + [0]
        start = 0
        for n in [len(ids) % capacity] * (len(ids) % capacity > 0) + [capacity] * (len(ids) // capacity):
            out.append((i, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes())))
            start += n
    return out


@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing_holds_every_piece_once(spark, capacity):
    got = packing.pack(frame(spark), JSON, vocab.PATTERN, capacity, group=20).collect()
    key = lambda r: (repr(r[0]), *r[1:])
    assert sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) \
        == sorted(library_pieces(rows(), capacity), key=key)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= capacity
    assert packing.pack(frame(spark, []), JSON, vocab.PATTERN, capacity).count() == 0


def optimum(lengths, capacity):
    """The least number of bins, by trying."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def put(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for r in sorted(set(range(len(rooms)))):
            if rooms[r] >= lengths[i]:
                put(i + 1, rooms[:r] + [rooms[r] - lengths[i]] + rooms[r + 1:])
        put(i + 1, rooms + [capacity - lengths[i]])

    put(0, [])
    return best[0]


def test_bound_and_best_fit_around_the_optimum():
    rng = random.Random(8)
    for _ in range(60):
        capacity = rng.choice([10, 21, 30])
        lengths = np.array(sorted((rng.randint(1, capacity - 1) for _ in range(8)), reverse=True))
        bins, left = packing.best_fit(lengths, capacity)
        bound = packing.lower_bound(np.bincount(lengths), capacity)
        best = optimum(lengths.tolist(), capacity)
        assert np.ceil(bound - 1e-9) <= best <= len(left)
        assert (np.bincount(bins, lengths) + left == capacity).all()


def test_exchange_lowers_the_count(spark):
    # Many small partitions that each leave room: exchanged, they come near the bound of all pieces.
    rng = random.Random(1)
    items = [(i, rng.randint(300, 900)) for i in range(600)]
    df = spark.createDataFrame(items, "key BIGINT, length BIGINT")
    places = packing.place(df, 2048, group=30)
    bound = packing.lower_bound(np.bincount([n for _, n in items]), 2048)
    alone = df.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(20)).cast("int")).groupBy("part").applyInPandas(
        packing.packed(2048), "key bigint, length bigint, sequence bigint, offset bigint, room bigint, bound double, part int")
    n = places.select("sequence").distinct().count()
    assert places.count() == 600
    assert bound <= n < alone.select("sequence").distinct().count()
