"""Letters and numbers as the tokenizers' libraries know them.

The ``regex`` module may know a later Unicode than the libraries: what it holds for a letter is an unassigned sign to them.
``agreed`` narrows its classes to theirs.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import regex

CLASSES = (r"\p{L}", r"\p{N}")


@lru_cache(maxsize=1)
def later_letters() -> str:
    """Letters and numbers for ``regex`` only, as ranges of a character class (empty if there are none)."""
    from tokenizers import Regex, pre_tokenizers

    points = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    new = "".join(c for c in regex.findall("[" + "".join(CLASSES) + "]", points) if unicodedata.category(c) == "Cn")
    split = pre_tokenizers.Split(Regex("[" + "".join(CLASSES) + "]"), "removed", invert=True)
    theirs = {c for c, _ in split.pre_tokenize_str(new)}
    ranges: list[list[int]] = []
    for point in map(ord, filter(lambda c: c not in theirs, new)):
        if ranges and ranges[-1][1] == point - 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


@lru_cache(maxsize=16)
def agreed(pattern: str) -> regex.Pattern:
    """``pattern`` with both classes as the libraries have them."""
    later = later_letters()
    if later:
        for name in CLASSES:
            pattern = pattern.replace(name, f"[{name}--[{later}]]")
    return regex.compile(pattern, regex.V1)
