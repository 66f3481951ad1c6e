"""A cuckoo filter over 64-bit key pairs, with whole batches as numpy operations."""

from __future__ import annotations

import numpy as np

SLOTS = 4
#: Rounds of moves after which a filter counts as full.
ROUNDS = 500
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _unsigned(x) -> np.ndarray:
    return np.ascontiguousarray(x, np.int64).view(np.uint64)


class CuckooFilter:
    """16-bit marks in buckets of four slots; a key's mark stands in one of its two buckets.

    ``contains`` has no false negatives; a false positive is as likely as about 8 in 65536.
    """

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = np.uint64(len(table) - 1)

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * 0.8 < n:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, h1, h2) -> CuckooFilter:
        """A filter that holds these keys, as large as it takes."""
        n = max(len(h1), 1)
        while True:
            new = cls.sized(n)
            if new.insert(h1, h2):
                return new
            n *= 2

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def places(self, h1, h2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(marks, first buckets, second buckets)."""
        mark = (_unsigned(h2) >> np.uint64(48)).astype(np.uint16)
        mark = np.maximum(mark, 1)  # 0 is a free slot
        first = (_unsigned(h1) >> np.uint64(20)) & self.mask
        return mark, first.astype(np.int64), self.other(first.astype(np.int64), mark)

    def other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            step = (mark.astype(np.uint64) * _MIX) >> np.uint64(24)
        return ((bucket.astype(np.uint64) ^ step) & self.mask).astype(np.int64)

    def contains(self, h1, h2) -> np.ndarray:
        mark, a, b = self.places(h1, h2)
        return (self.table[a] == mark[:, None]).any(axis=1) | (self.table[b] == mark[:, None]).any(axis=1)

    def insert(self, h1, h2) -> bool:
        """Add distinct keys that are not in it yet; False if it is full (and then of no more use)."""
        mark, bucket, _ = self.places(h1, h2)
        rng = np.random.default_rng(len(mark))
        for turn in range(ROUNDS):
            if not len(mark):
                return True
            order = np.argsort(bucket, kind="stable")
            mark, bucket = mark[order], bucket[order]
            new = np.append(True, bucket[1:] != bucket[:-1])
            rank = np.arange(len(bucket)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            free = self.table[bucket] == 0
            fits = rank < free.sum(axis=1)
            # The slot of an item is the rank-th free one of its bucket.
            nth = np.cumsum(free, axis=1) - 1
            slot = np.argmax(free & (nth == rank[:, None]), axis=1)
            self.table[bucket[fits], slot[fits]] = mark[fits]
            mark, bucket, rank = mark[~fits], bucket[~fits], rank[~fits]
            if turn:  # both buckets were full: one item for each bucket takes another's slot
                new = np.append(True, bucket[1:] != bucket[:-1])[:len(bucket)]
                at = bucket[new]
                slot = rng.integers(0, SLOTS, len(at))
                mark[new], self.table[at, slot] = self.table[at, slot], mark[new].copy()
            bucket = self.other(bucket, mark)
        return not len(mark)

    def remove(self, h1, h2) -> None:
        """Take out distinct keys, all of which are in it."""
        mark, a, b = self.places(h1, h2)
        left = np.arange(len(mark))
        while len(left):
            low = np.minimum(a[left], b[left])  # the same for all keys of one mark and pair of buckets
            _, one = np.unique(low * 65536 + mark[left], return_index=True)
            now = left[one]  # no two of these are after the same slot
            left = np.delete(left, one)
            for bucket in (a, b):
                hit = self.table[bucket[now]] == mark[now, None]
                found = hit.any(axis=1)
                self.table[bucket[now][found], hit[found].argmax(axis=1)] = 0
                now = now[~found]
