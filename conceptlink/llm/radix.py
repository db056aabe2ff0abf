"""Adaptive radix tree over byte strings: node layouts that grow with their children, and compressed paths."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Few:
    """Up to 4 and then up to 16 children: sorted bytes beside the children."""

    __slots__ = ("room", "bytes", "kids")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def get(self, b: int):
        i = bisect_left(self.bytes, b)
        return self.kids[i] if i < len(self.bytes) and self.bytes[i] == b else None

    def put(self, b: int, child) -> Few | Indexed:
        i = bisect_left(self.bytes, b)
        if i < len(self.bytes) and self.bytes[i] == b:
            self.kids[i] = child
        elif len(self.kids) < self.room:
            self.bytes.insert(i, b)
            self.kids.insert(i, child)
        else:
            larger = Few(16) if self.room == 4 else Indexed()
            for old, kid in self.items():
                larger = larger.put(old, kid)
            return larger.put(b, child)
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return zip(self.bytes, self.kids)


class Indexed:
    """Up to 48 children: 256 one-byte places in a short list."""

    __slots__ = ("place", "kids")

    def __init__(self):
        self.place, self.kids = bytearray(256), []

    def get(self, b: int):
        i = self.place[b]
        return self.kids[i - 1] if i else None

    def put(self, b: int, child) -> Indexed | Full:
        i = self.place[b]
        if i:
            self.kids[i - 1] = child
        elif len(self.kids) < 48:
            self.kids.append(child)
            self.place[b] = len(self.kids)
        else:
            full = Full()
            for old, kid in self.items():
                full.put(old, kid)
            return full.put(b, child)
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return ((b, self.kids[i - 1]) for b, i in enumerate(self.place) if i)


class Full:
    """A slot for every byte."""

    __slots__ = ("kids",)

    def __init__(self):
        self.kids = [None] * 256

    def get(self, b: int):
        return self.kids[b]

    def put(self, b: int, child) -> Full:
        self.kids[b] = child
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)


class Node:
    """``path`` are the bytes after the branching byte that lead here; ``values`` belong to strings that end here."""

    __slots__ = ("path", "below", "values")

    def __init__(self, path: bytes):
        self.path, self.below, self.values = path, None, []

    def link(self, b: int, child: Node) -> None:
        self.below = (self.below or Few()).put(b, child)


def _common(key: bytes, at: int, path: bytes) -> int:
    """Length of the common start of ``key`` from ``at`` and ``path``."""
    if key.startswith(path, at):
        return len(path)
    low, high = 0, min(len(path), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key.startswith(path[:mid], at):
            low = mid
        else:
            high = mid - 1
    return low


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while True:
            n = _common(key, at, node.path)
            at += n
            if n < len(node.path):  # the string leaves the path: cut it here
                rest = Node(node.path[n + 1 :])
                rest.below, rest.values = node.below, node.values
                branch, node.path = node.path[n], node.path[:n]
                node.below, node.values = None, []
                node.link(branch, rest)
            if at == len(key):
                node.values.append(value)
                return
            child = node.below.get(key[at]) if node.below else None
            if child is None:
                child = Node(key[at + 1 :])
                child.values.append(value)
                node.link(key[at], child)
                return
            node, at = child, at + 1

    def walk(self) -> Iterator[tuple[int, bytes, Node]]:
        """(byte depth at which it begins, bytes, node) of every edge, parents first, in byte order."""
        stack = [(0, self.root.path, self.root)]
        while stack:
            at, edge, node = stack.pop()
            yield at, edge, node
            if node.below:
                end = at + len(edge)
                stack += [(end, bytes((b,)) + kid.path, kid) for b, kid in reversed(list(node.below.items()))]
