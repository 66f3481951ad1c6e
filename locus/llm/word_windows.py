"""Hashes of all windows of a text's words, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes a worker remembers; it starts anew beyond that.
MEMO = 500_000
#: Odd factors of the two rolling sums; the first is its own for each place in a window.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


_WORDS = _Words()
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(factor: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """factor^i and its inverse modulo 2^64, for i < n."""
    have = _POWERS.get(factor)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, n.bit_length())
        up, down = np.full(size, factor, np.uint64), np.full(size, pow(factor, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = _POWERS[factor] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Runs of anything but ASCII white space."""
    return text.encode().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash for each window of ``length`` words; ``which`` is one of two independent ones."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = powers(FACTORS[which], n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((mix(hashes) if which else hashes) * down, out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * up[:n - length + 1])


def sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) over every ``width`` neighbours, in log2(width) steps."""
    have = 1
    while 2 * have <= width:
        x, have = least(x[:-have], x[have:]), 2 * have
    return least(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def anchors(hashes: np.ndarray, short: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the windows of ``short`` words that are the least inside some window of
    ``length`` words.  Which ones these are depends on that window's words only, so two equal windows of
    ``length`` words have the same anchors at the same places."""
    small = window_hashes(hashes, short)
    width = length - short + 1
    if len(small) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = sliding(small, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    most = sliding(np.concatenate([pad, least, pad]), width, np.maximum)
    at = np.flatnonzero(small == most)
    return at, small[at]
