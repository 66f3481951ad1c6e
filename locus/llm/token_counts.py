"""Token counts by a compiled finite-state transducer (word-end BPE).

The tokenizer file (normaliser NFC, white space to one space, lower case;
pre-tokens of one class; byte-pair merges with a word-end mark) is compiled,
transition by transition as texts need them, into a deterministic transducer
over bytes.  A transition carries the change of the number of tokens of the
word read so far, so the sum along a path is the word's token count and no
token list is ever built.

Why a finite state is enough: the last token of a prefix is the one token that
ends there and is compatible with the last token of the prefix before it (two
tokens are compatible if encoding their concatenation gives them back).  A token
that ends later can only start inside the longest suffix that is still a proper
prefix of some token.  A state is that suffix plus, for each position in it,
the last token and the relative count.

A whole text runs through a machine whose state is the place in the pre-token pattern (at rest, a beginning of
a contraction such as "'r", within letters, within other signs) and, within a word, the transducer's state and
the one byte that is still held back, as the last byte of a word carries the end mark.  What stands between two
stretches of white space leads from rest to rest, so workers remember its count as one long transition.

Long texts are cut into chunks, before code points that normalisation never joins to what precedes them.  What a
chunk does is a state map: entry state to (exit state, tokens).  It is tabulated for each chunk apart, at first for
the entry state that the last ``LOOKBACK`` code points before the chunk lead to; another entry state, if
a composition asks for one, is run through the chunk and joins the table.  A parallel prefix scan composes the
maps; each prefix gives the tokens up to the end of its chunk.  A map holds a few numbers however long its chunk is, also where
there is no white space at all, and is exact for every entry state.  (Only a stretch without any such code point, as of
combining marks alone, stays in one chunk.)

Special strings of the file are single tokens wherever they stand, as by default
in the library.

Nulls and empty texts count 0 tokens.  Repeated rows each get their own row;
other columns are ignored.  The texts never leave their task.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame

from locus.llm.columns import map_rows, texts
from locus.llm.unicode_classes import agreed

#: Code points of a chunk, and how many before it its first entry state is found from.
CHUNK, LOOKBACK = 1 << 15, 1 << 8
#: States, and known pairs of tokens, beyond which a worker starts anew before the next text.
STATES, PAIRS = 200_000, 1_000_000
#: Runs and words whose counts a worker remembers; it starts anew beyond that.
MEMO = 400_000
#: Code points of a run or word that is remembered; longer ones hardly come again.
REMEMBERED = 1024
#: Control characters that Python's split takes for white space and the file doesn't.
SEPARATORS = "\x1c\x1d\x1e\x1f"
SPACE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
#: What the file's pre-tokeniser takes as words of normalised text.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: The words that are more than one class, and what may still become one.
CONTRACTIONS, BEGUN = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"), ("'", "'r", "'v", "'l")
#: How a word of either class goes on.
MORE = {"L": r"\p{L}*", "O": r"[^\s\p{L}\p{N}]*"}
#: A state is (kind, transducer state, byte held back); kind: a class, or what a contraction has begun with, if anything.
State = tuple[str, int, int]
REST: State = ("", 0, 0)


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Transducer:
    """Counts the tokens of words, byte by byte."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        self.end = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {tuple(m): i for i, m in enumerate(merges)}
        self.letters = [letters[b] for b in range(256)]
        self.symbols = self.letters + [c + self.end for c in self.letters]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.tokens: set[tuple[str, ...]] = set()
        self.beginnings: set[tuple[str, ...]] = {()}
        for token in model["vocab"]:
            body = token[: -len(self.end)] if self.end and token.endswith(self.end) else token
            word = (*body[:-1], body[-1:] + token[len(body):]) if body else ()
            if word and self.merge(word) == [word]:
                self.tokens.add(word)
                self.beginnings.update(word[:i] for i in range(1, len(word)))
        self.memo: dict[str, int] = {}  # of runs
        self.words: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        """Forget all transitions; they are compiled anew where they are needed."""
        self.pairs: dict[tuple, bool] = {}
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.table: list[dict[int, tuple[int, int]]] = []
        self.start = self.state(((), ((None, 0),)))

    def merge(self, symbols: tuple[str, ...]) -> list[tuple[str, ...]]:
        """The tokens of a short symbol sequence, each as its symbols."""
        parts = [(s,) for s in symbols]
        while len(parts) > 1:
            ranks = [self.rank.get(("".join(a), "".join(b))) for a, b in zip(parts, parts[1:])]
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                break
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, left: tuple | None, right: tuple) -> bool:
        if left is None:
            return True
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def state(self, key: tuple) -> int:
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            self.table.append({})
        return number

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """(next state, change of the count); ``symbol``: a byte, plus 256 if it ends the word."""
        suffix, places = self.states[state]
        read = (*suffix, self.symbols[symbol])
        for i, (last, count) in enumerate(places):  # the longest token first
            token = read[i:]
            if token in self.tokens and self.compatible(last, token):
                break
        else:
            raise ValueError(f"no token ends with {read[-1]!r}")
        change = count + 1
        if symbol >= 256:
            reached = self.start
        else:
            now = [(last, n - change) for last, n in places] + [(token, 0)]
            cut = next(i for i in range(len(read) + 1) if read[i:] in self.beginnings)
            # Before the first byte of a word no token stands; later, the suffix may be shorter.
            reached = self.state((read[cut:], tuple(now[cut:])))
        self.table[state][symbol] = reached, change
        return reached, change

    def read(self, state: int, symbols) -> tuple[int, int]:
        """(state, change of the count) after these symbols."""
        total, table = 0, self.table
        for symbol in symbols:
            try:
                state, change = table[state][symbol]
            except KeyError:
                state, change = self.step(state, symbol)
            total += change
        return state, total

    def word(self, word: str) -> int:
        """Tokens of a whole word, remembered."""
        got = self.words.get(word)
        if got is None:
            data = word.encode()
            got = self.read(self.start, chain(memoryview(data)[:-1], (data[-1] + 256,)))[1]
            if len(word) <= REMEMBERED:
                if len(self.words) >= MEMO:
                    self.words.clear()
                self.words[word] = got
        return got

    def count(self, run: str) -> int:
        """Tokens of a stretch without white space that stands between two boundaries: from rest to rest."""
        got = self.memo.get(run)
        if got is None:
            got = sum(map(self.word, words_of(normal(run))))
            if len(run) <= REMEMBERED:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[run] = got
        return got

    # --- the machine over texts ---------------------------------------------

    def go_on(self, kind: str, state: int, data: bytes) -> tuple[State, int]:
        """Within a word, after the bytes of ``data``; the last one is held back."""
        state, n = self.read(state, memoryview(data)[:-1])
        return (kind, state, data[-1]), n

    def glide(self, state: State, run: str) -> tuple[State, int]:
        """(state, tokens) after a stretch without white space that may go on."""
        kind, inner, held = state
        text, at, total = normal(run), 0, 0
        if kind in MORE:
            at = agreed(MORE[kind]).match(text).end()
            if at == len(text):
                return self.go_on(kind, inner, bytes((held,)) + text.encode())
            data = bytes((held,)) + text[:at].encode()
            total = self.read(inner, chain(memoryview(data)[:-1], (data[-1] + 256,)))[1]
        else:
            text = kind + text
        words = words_of(text, at)
        begun = "".join(words[-2:]) if words[-2:-1] == ["'"] else words[-1]
        if begun in BEGUN:  # each of its characters is a word so far
            return (begun, 0, 0), total + sum(map(self.word, words[:-len(begun)]))
        open_kind = None if words[-1] in CONTRACTIONS else next((k for k in MORE if agreed(MORE[k]).match(words[-1]).end()), None)
        if open_kind is None:  # a contraction or a number, which nothing continues
            return REST, total + sum(map(self.word, words))
        total += sum(map(self.word, words[:-1]))
        state, n = self.go_on(open_kind, self.start, words[-1].encode())
        return state, total + n

    def finish(self, state: State) -> int:
        """What the end of a word or of the text adds."""
        kind, inner, held = state
        return self.read(inner, (held + 256,))[1] if kind in MORE else sum(map(self.word, kind))

    def advance(self, state: State, chunk: str, last: bool) -> tuple[State, int]:
        """(exit state, tokens) of a chunk; ``last``: the text ends with it."""
        head, *inner = SPACE.split(chunk) if any(c in chunk for c in SEPARATORS) else split(chunk)
        if not inner and not last:
            return self.glide(state, head) if head else (state, 0)
        if state == REST:
            total = self.count(head) if head else 0
        else:
            state, total = self.glide(state, head) if head else (state, 0)
            total += self.finish(state)
        tail = "" if last or not inner else inner.pop()
        total += sum(map(self.count, inner))
        state, n = self.glide(REST, tail) if tail else (REST, 0)
        return state, total + n

    def cuts(self, text: str, chunk: int) -> list[int]:
        """Where the chunks of a text begin, and its end."""
        out, n = [0], len(text)
        while (at := out[-1] + chunk) < n:
            while at < n and not starts(text[at]):
                at += 1
            if at < n:
                out.append(at)
            else:
                break
        return [*out, n]

    def prefixes(self, text: str, chunk: int = CHUNK) -> list[int]:
        """Tokens up to the end of each chunk of a text without special strings; a word that is open there counts as far as read."""
        if len(text) <= chunk:
            return [self.advance(REST, text, True)[1]]
        cuts, maps = self.cuts(text, chunk), []
        for a, b in zip(cuts, cuts[1:]):
            new = StateMap(lambda s, a=a, b=b: self.advance(s, text[a:b], b == len(text)))
            new(self.advance(REST, text[max(0, a - LOOKBACK):a], False)[0])
            maps.append(new)
        return [m(REST)[1] for m in prefix_scan(maps)]

    def text(self, text: str, chunk: int = CHUNK) -> list[int]:
        """Tokens up to the end of each chunk; chunks also end before and after special strings, which are one token each."""
        if len(self.states) > STATES or len(self.pairs) > PAIRS:
            self.clear()
        out, before, at = [], 0, 0
        if any(s in text for s in self.specials):
            for m in self.special.finditer(text):
                out += [before + n for n in self.prefixes(text[at:m.start()], chunk)]
                before = out[-1] + 1
                out.append(before)
                at = m.end()
            text = text[at:]
        return out + [before + n for n in self.prefixes(text, chunk)]


class StateMap:
    """What a stretch of text does to a state: a table of entry state to (exit state, tokens), filled in where asked."""

    def __init__(self, run: Callable[[State], tuple[State, int]]):
        self.run = run
        self.table: dict[State, tuple[State, int]] = {}

    def __call__(self, state: State) -> tuple[State, int]:
        got = self.table.get(state)
        if got is None:
            got = self.table[state] = self.run(state)
        return got

    def then(self, after: StateMap) -> StateMap:
        """The map of this stretch and the next one, for all entry states known here."""
        def run(state: State) -> tuple[State, int]:
            middle, n = self(state)
            end, more = after(middle)
            return end, n + more

        out = StateMap(run)
        for state in list(self.table):
            out(state)
        return out


def prefix_scan(maps: list[StateMap]) -> list[StateMap]:
    """All inclusive prefixes: neighbours are composed in pairs, the pairs scanned, and what stands between them filled in.
    The compositions of a round don't need each other; there are 2 log2(n) rounds and less than 2 n compositions."""
    if len(maps) < 2:
        return maps
    pairs = prefix_scan([a.then(b) for a, b in zip(maps[::2], maps[1::2])])
    return [pairs[i // 2] if i % 2 else pairs[i // 2 - 1].then(m) if i else m for i, m in enumerate(maps)]


def split(chunk: str) -> list[str]:
    """``chunk`` between its stretches of white space, with an empty text where it begins or ends in one."""
    runs = chunk.split()
    if not runs:
        return ["", ""] if chunk else [""]
    return [""] * chunk[0].isspace() + runs + [""] * chunk[-1].isspace()


def starts(c: str) -> bool:
    """Whether normalisation leaves ``c`` apart from all that stands before it: no mark, no vowel or final of Hangul."""
    return c < "\u0300" or not (unicodedata.category(c) in ("Mn", "Mc", "Me", "Cn") or "\u1160" <= c <= "\u11ff"
                               or unicodedata.normalize("NFC", c) != c)


def words_of(text: str, at: int = 0) -> list[str]:
    """The words of normalised text from place ``at``, a boundary."""
    return (WORDS if text.isascii() else agreed(WORDS.pattern)).findall(text, at)


def normal(run: str) -> str:
    """A stretch without white space as the file normalises it."""
    return run.lower() if run.isascii() else normaliser()(run)


_NORMALISER: list = []


def normaliser():
    """The file's own normaliser without its white-space rule: NFC, then lower case."""
    if not _NORMALISER:
        from tokenizers import normalizers
        _NORMALISER.append(normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str)
    return _NORMALISER[0]


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, chunk_tokens) for every row of ``docs``; ``chunk_tokens`` are the tokens up to the
    end of each chunk, the last of them ``n_tokens``."""
    def rows(row):
        key, text = row
        counts = transducer(path).text(text)
        yield key, len(text.encode()), counts[-1], counts[-1] > limit, counts

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_rows(texts(docs, id_col, text_col), rows,
                   f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, chunk_tokens array<bigint>")
    return out.withColumnRenamed("id", id_col)
