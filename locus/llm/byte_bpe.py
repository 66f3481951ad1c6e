"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks that overlap.  Each chunk is split into pre-tokens on
its own, as if it were a text.  A match of the pre-token pattern depends on what
stands at and after its start only, so once two neighbouring chunks have a
boundary in common inside their overlap, they agree from there on: the texts
are stitched at the first such boundary.  Matches near a chunk's end may have
been cut short and are not trusted.  If a pair of chunks has no common boundary
(a run of one class longer than the overlap), the earlier chunk is split again from
its last trusted boundary over twice as much text, until it meets one.

The pre-tokens are then encoded one by one (least rank first, leftmost among
equals) and remembered.  Decoding looks up each id and concatenates raw bytes.

Nulls and empty texts have no ids.  Repeated rows each get their own row; other
columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import json
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from locus.llm.columns import texts

#: Code points of a chunk, and how many more it shares with the next one.
CHUNK, OVERLAP = 1 << 15, 1 << 10
#: A match that ends so close to a chunk's end may have been cut short.
MARGIN = 4
#: Pre-tokens whose ids a worker remembers, twice: the latest, and those before.
MEMO = 250_000
#: Bytes of a pre-token that is merged by a plain list; and a rank above all others.
SHORT, NONE = 64, 1 << 62
#: Bytes of ids or decoded text that a worker hands back to Spark at once.
BYTES_OUT = 8 << 20


def pre_tokens(text: str, pattern: regex.Pattern, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """All matches of ``pattern``, which must cover any text without gaps."""
    n = len(text)
    if n <= chunk + overlap:
        return pattern.findall(text)
    spans = [(a, min(n, a + chunk + overlap)) for a in range(0, n, chunk)]
    return stitch(text, pattern, spans, [pattern.findall(text[a:b]) for a, b in spans])


def stitch(text: str, pattern: regex.Pattern, spans: list[tuple[int, int]], parts: list[list[str]]) -> list[str]:
    """Join the pre-tokens of overlapping chunks (see above); ``spans`` are their places."""
    def ends(start: int, words: list[str]) -> np.ndarray:
        return start + np.cumsum([0, *map(len, words)])

    out: list[str] = []
    words, at = parts[0], ends(spans[0][0], parts[0])
    k, stop, n = 1, spans[0][1], len(text)
    while stop < n:
        a, b = spans[k]
        other = ends(a, parts[k])
        common = np.intersect1d(at[at >= a], other)
        common = common[common <= stop - MARGIN]
        if len(common):
            out += words[:np.searchsorted(at, common[0])]
            cut = np.searchsorted(other, common[0])
            words, at, stop, k = parts[k][cut:], other[cut:], b, k + 1
            continue
        last = np.searchsorted(at, stop - MARGIN, "right") - 1  # trusted up to here
        last = max(int(last), 0)
        out += words[:last]
        start = int(at[last])
        stop = min(n, max(b, start + 2 * (stop - start)))
        words = pattern.findall(text[start:stop])
        at = ends(start, words)
        while k < len(spans) and spans[k][1] <= stop:
            k += 1
        if k == len(spans):
            break
    if stop < n:
        raise AssertionError("chunks must cover the text")
    return out + words


class ByteBpe:
    """Ids of pre-tokens by a ``.tiktoken`` rank file or a byte-level ``.json``.

    ``library`` leaves the merges of pre-tokens not yet remembered (in ``encode_whole``: the splitting too) to
    tiktoken, for callers that only need the ids (possible if the file's merges are in id order).
    """

    def __init__(self, path: str, pattern: str, library: bool = False, memo: int = MEMO):
        self.limit = memo
        self.pattern = regex.compile(pattern)
        self.special: dict[str, int] = {}
        if path.endswith(".json"):
            from locus.llm.token_counts import byte_letters

            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            back = {c: b for b, c in byte_letters().items()}
            raw = lambda s: bytes(map(back.__getitem__, s))
            self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            self.ids = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in self.special}
            merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
            order = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
            first = raw("".join(merges[0])) if merges else b""
            by_id = all(self.ids[a + b] - self.ids[first] == i for (a, b), i in order.items())
            self.rank = (lambda a, b: get(a + b, NONE)) if by_id else (lambda a, b: order.get((a, b), NONE))
        else:
            with open(path, "rb") as f:
                self.ids = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
            by_id, self.rank = True, lambda a, b: get(a + b, NONE)
        get = self.ids.get
        self.library = None
        if by_id and library:
            import tiktoken

            self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ids, special_tokens={})
            self.merge = self.library._encode_single_piece
        self.bytes = {i: t for t, i in self.ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cut = regex.compile(r"(?<=\S) ")

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token: always the leftmost pair of least rank is merged."""
        if len(data) > SHORT:
            return self.merge_long(data)
        rank = self.rank
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = [rank(a, b) for a, b in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != NONE:
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i], parts[i + 1])
            if i:
                ranks[i - 1] = rank(parts[i - 1], parts[i])
        return [self.ids[p] for p in parts]

    def merge_long(self, data: bytes) -> list[int]:
        """The same for long pre-tokens, by a heap over a linked list."""
        parts: list[bytes | None] = [data[i:i + 1] for i in range(len(data))]
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (r := self.rank(parts[i], parts[j])) != NONE:
                heapq.heappush(heap, (r, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] is not left or j < 0 or parts[j] is not right:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = left + right, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [self.ids[p] for p in parts if p is not None]

    def piece(self, word: str) -> bytes:
        """The ids of a pre-token as little-endian unsigned 32-bit numbers."""
        got = self.older.get(word)
        if got is None:
            ids = self.merge(word.encode())
            got = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) < 256:
            if len(self.memo) >= self.limit:
                self.older, self.memo = self.memo, {}
            self.memo[word] = got
        return got

    def encode(self, text: str) -> bytes:
        """All ids of a text, packed as in ``piece``; special strings of the file are one id each."""
        if self.specials and self.specials.search(text):
            out, at = [], 0
            for m in self.specials.finditer(text):
                out += self.plain(text[at:m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()
                at = m.end()
            return b"".join(out) + self.plain(text[at:])
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        piece = self.piece
        return b"".join([self.memo.get(w) or piece(w) for w in pre_tokens(text, self.pattern)])

    def encode_whole(self, text: str, chunk: int = CHUNK) -> bytes:
        """``encode``, for callers that only need the ids: the library splits and merges stretches of a text.

        A space after anything but white space always starts a pre-token, and no match looks back, so a long text can
        be cut there.  What has no such place for long is left to the chunks that overlap.
        """
        if self.library is None or self.specials and self.specials.search(text):
            return self.encode(text)
        out, at = [], 0
        while at < len(text):
            end = len(text)
            if end - at > chunk:
                place = self.cut.search(text, at + chunk // 2 + 1, at + chunk)
                if place is None:
                    place = self.cut.search(text, at + chunk)
                    end = place.start() if place else end
                    out.append(self.plain(text[at:end]))
                    at = end
                    continue
                end = place.start()
            ids = self.library.encode_to_numpy(text[at:end], disallowed_special=())
            out.append(ids.astype("<u4", copy=False).tobytes())
            at = end
        return b"".join(out)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str, library: bool = False, memo: int = MEMO) -> ByteBpe:
    return ByteBpe(path, pattern, library, memo)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) for every row of ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = codec(path, pattern, True)  # tiktoken merges pre-tokens that are not yet remembered
        for batch in batches:
            packed, first, size = [], 0, 0
            for i, text in enumerate(batch.column(1)):
                packed.append(bpe.encode(text.as_py()))
                size += len(packed[-1])
                if size >= BYTES_OUT or i + 1 == batch.num_rows:
                    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype("i4")
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(packed)), ids], ["id", "ids"])
                    first, packed, size = i + 1, [], 0

    out = texts(docs, id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tokens`` (any columns, with ``ids``) plus ``decoded``, the raw bytes of its ids."""
    from pyspark.sql.types import BinaryType, StructType

    schema = StructType([*tokens.schema.fields]).add("decoded", BinaryType())
    at = tokens.columns.index("ids")

    def run(batches):
        bpe = codec(path, pattern)
        for batch in batches:
            first, done, size = 0, [], 0
            for i, ids in enumerate(batch.column(at)):
                done.append(bpe.decode(ids.values.to_pylist()))
                size += len(done[-1])
                if size >= BYTES_OUT or i + 1 == batch.num_rows:
                    part = batch.slice(first, len(done))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(done, pa.binary())],
                                                     [*batch.schema.names, "decoded"])
                    first, done, size = i + 1, [], 0

    return tokens.mapInArrow(run, schema)
