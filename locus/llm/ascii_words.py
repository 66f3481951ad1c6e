"""Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of texts with A-Z in lower case, a bounded piece at a time."""

from __future__ import annotations

from collections.abc import Iterator

#: ASCII letters and digits stay (letters in lower case), other ASCII becomes a space, all else stays.
TO_WORDS = bytes(i if i >= 128 or chr(i).islower() or chr(i).isdigit() else i + 32 if chr(i).isupper() else 32
                 for i in range(256))
#: Bytes of a piece.
PIECE = 1 << 15


def pieces(text: bytes, carry: int = 0, size: int = PIECE) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first, old, words) for pieces of a UTF-8 text, cut between words.

    The first ``old`` words (at most ``carry``) of a piece are the last ones of the piece before; ``first`` is the
    number of the piece's first word in the text.  A piece holds about ``size`` bytes, or one word if that
    is longer, whatever the length of the text.
    """
    at = seen = 0
    tail: list[bytes] = []
    while at < len(text):
        end, words = at, tail
        while end < len(text) and len(words) == len(tail):
            # Up to the first byte that stands between words, at or after the size wished for.
            stop = min(end + size, len(text))
            while stop < len(text) and TO_WORDS[text[stop]] != 32:
                stop += 1
            words = tail + text[end:stop].translate(TO_WORDS).split()
            end = stop
        if len(words) > len(tail):
            yield seen - len(tail), len(tail), words
            seen += len(words) - len(tail)
            tail = words[-carry:] if carry else []
        at = end


def count(text: bytes) -> int:
    return sum(len(words) for _, _, words in pieces(text))
