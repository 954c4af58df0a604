"""An adaptive radix tree over byte strings that are whole numbers of fixed-width ids.

Inner nodes have four layouts by number of children (4, 16, 48, 256) and grow from one
to the next; a run of bytes without a branch is kept once, in the node below it.  A key
may end at any node, also inside such a run, which is cut there.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Small:
    """Up to 4 or 16 children: sorted bytes beside the children."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def get(self, byte: int):
        i = bisect_left(self.bytes, byte)
        return self.nodes[i] if i < len(self.bytes) and self.bytes[i] == byte else None

    def put(self, byte: int, node):
        """The layout that holds the child too: itself, or the next larger one."""
        i = bisect_left(self.bytes, byte)
        if i < len(self.bytes) and self.bytes[i] == byte:
            self.nodes[i] = node
            return self
        if len(self.bytes) == self.room:
            larger = Small(16) if self.room == 4 else Indexed()
            for b, n in zip(self.bytes, self.nodes):
                larger = larger.put(b, n)
            return larger.put(byte, node)
        self.bytes.insert(i, byte)
        self.nodes.insert(i, node)
        return self

    def children(self) -> list:
        return self.nodes


class Indexed:
    """Up to 48 children: a byte's entry says where its child lies."""

    __slots__ = ("index", "nodes")

    def __init__(self):
        self.index, self.nodes = bytearray(b"\xff" * 256), []

    def get(self, byte: int):
        i = self.index[byte]
        return None if i == 255 else self.nodes[i]

    def put(self, byte: int, node):
        i = self.index[byte]
        if i != 255:
            self.nodes[i] = node
            return self
        if len(self.nodes) == 48:
            larger = Full()
            for b in range(256):
                if self.index[b] != 255:
                    larger.put(b, self.nodes[self.index[b]])
            return larger.put(byte, node)
        self.index[byte] = len(self.nodes)
        self.nodes.append(node)
        return self

    def children(self) -> list:
        return [self.nodes[i] for i in self.index if i != 255]


class Full:
    """One place for every byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node):
        self.nodes[byte] = node
        return self

    def children(self) -> list:
        return [n for n in self.nodes if n is not None]


class Node:
    """``path``: the bytes between the parent's branch and this node, branch byte included."""

    __slots__ = ("path", "below", "ends", "sample")

    def __init__(self, path: bytes, sample):
        self.path, self.sample = path, sample
        self.below = None
        self.ends: list = []

    def children(self) -> list:
        return self.below.children() if self.below is not None else []

    def adopt(self, child: Node) -> None:
        self.below = (self.below or Small()).put(child.path[0], child)


def _common(a: bytes, b: memoryview | bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] agrees, a[:hi] does not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class RadixTree:
    """Keys with values; a node remembers the first value below it as its ``sample``."""

    def __init__(self):
        self.root = Node(b"", None)

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        if node.sample is None:
            node.sample = value
        while at < len(key):
            child = node.below.get(key[at]) if node.below is not None else None
            if child is None:
                child = Node(key[at:], value)
                node.adopt(child)
                node, at = child, len(key)
                break
            rest = key[at:at + len(child.path)]
            same = _common(child.path, rest)
            if same < len(child.path):
                upper = Node(child.path[:same], child.sample)
                child.path = child.path[same:]
                upper.adopt(child)
                node.adopt(upper)
                child = upper
            node, at = child, at + same
        node.ends.append(value)

    def walk(self) -> Iterator[tuple[Node, int, int, bool]]:
        """(node, depth in bytes above its path, depth below it, leaving): each node
        once before and once after all below it, children in byte order."""
        stack = [(self.root, 0, False)]
        while stack:
            node, above, leaving = stack.pop()
            depth = above + len(node.path)
            yield node, above, depth, leaving
            if not leaving:
                stack.append((node, above, True))
                stack.extend((c, depth, False) for c in reversed(node.children()))
