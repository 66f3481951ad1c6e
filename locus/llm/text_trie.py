"""A compressed radix trie over whole texts, with the least id of each text at its terminal."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any


class Node:
    __slots__ = ("edge", "kids", "ends", "least", "rows")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.kids: dict[int, Node] = {}
        #: Whether a text ends here, the least id of those that do (null if none has one), and what ``add`` was given with each.
        self.ends, self.least = False, None
        self.rows: list[tuple] = []


def shared(a: bytes, b: bytes, at: int) -> int:
    """How many bytes ``a`` and ``b[at:]`` begin with in common, by bisection over slices."""
    if b.startswith(a, at):
        return len(a)
    lo, hi = 0, min(len(a), len(b) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class TextTrie:
    def __init__(self):
        self.root = Node(b"")

    def place(self, text: bytes) -> Node:
        """The node at which ``text`` ends, made if need be."""
        node, at = self.root, 0
        while at < len(text):
            kid = node.kids.get(text[at])
            if kid is None:
                kid = node.kids[text[at]] = Node(text[at:])
                return kid
            n = shared(kid.edge, text, at)
            if n < len(kid.edge):
                # The edge splits where the texts part.
                fork = Node(kid.edge[:n])
                kid.edge = kid.edge[n:]
                fork.kids[kid.edge[0]] = kid
                node.kids[text[at]] = fork
                kid = fork
            node, at = kid, at + n
        return node

    def add(self, text: bytes, key: Any, row: tuple) -> None:
        """Insert a text with its id (nullable; a null one is larger than any) and keep ``row`` at its terminal."""
        node = self.place(text)
        node.ends = True
        if key is not None and (node.least is None or key < node.least):
            node.least = key
        node.rows.append((key, *row))

    def walk(self) -> Iterator[tuple[bytes, Any, list[tuple]]]:
        """(text, least id, rows) of every terminal, by a traversal that keeps the way down only."""
        stack = [(self.root, 0)]
        way: list[bytes] = []
        while stack:
            node, depth = stack.pop()
            del way[depth:]
            way.append(node.edge)
            if node.ends:
                yield b"".join(way), node.least, node.rows
            stack += [(kid, depth + 1) for kid in node.kids.values()]
