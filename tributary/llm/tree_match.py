"""Simple tree matching: the largest order-keeping match of two trees' nodes."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

#: Pairs of children whose whole table is kept; larger ones are halved first.
CELLS = 1 << 20

_PART = re.compile(r"[(),]|[^(),]+")


@dataclass(slots=True, eq=False)
class Tree:
    key: str
    place: int
    children: list[Tree] = field(default_factory=list)
    kind: int = 0  # equal for equal trees
    size: int = 1


def parse(shape: str, kinds: dict) -> Tree:
    """The tree of a shape ``a(b,c(d))``, its nodes numbered from the root down."""
    root = Tree("", -1)
    path, place = [root], 0
    for part in _PART.findall(shape):
        if part == "(":
            path.append(path[-1].children[-1])
        elif part == ")":
            path.pop()
        elif part != ",":
            path[-1].children.append(Tree(part, place))
            place += 1
    nodes = [root]
    for node in nodes:
        nodes.extend(node.children)
    for node in reversed(nodes):
        node.size = 1 + sum(child.size for child in node.children)
        node.kind = kinds.setdefault((node.key, *(c.kind for c in node.children)), len(kinds))
    return root.children[0]


class Match:
    """Weights of pairs of trees, each kind of pair worked out once."""

    def __init__(self) -> None:
        self.kinds: dict = {}
        self.known: dict[tuple[int, int], int] = {}

    def weight(self, a: Tree, b: Tree) -> int:
        """Nodes in the largest match of two trees, whose roots must match."""
        if a.key != b.key:
            return 0
        if a.kind == b.kind:
            return a.size
        pair = a.kind, b.kind
        if pair not in self.known:
            self.known[pair] = 1 + int(self._rows(a.children, b.children)[-1][-1])
        return self.known[pair]

    def _rows(self, a: list[Tree], b: list[Tree], whole: bool = False) -> list[np.ndarray]:
        """Largest matches of the first i of ``a`` with the first j of ``b``, by i."""
        row = np.zeros(len(b) + 1, np.int64)
        rows = [row]
        seen: dict[int, np.ndarray] = {}
        for x in a:
            if x.kind not in seen:
                seen[x.kind] = np.array([self.weight(x, y) for y in b], np.int64)
            new = row.copy()
            np.maximum(row[1:], row[:-1] + seen[x.kind], out=new[1:])
            row = np.maximum.accumulate(new)
            if whole:
                rows.append(row)
            else:
                rows = [row]
        return rows

    def _aligned(self, a: list[Tree], b: list[Tree]) -> list[tuple[Tree, Tree]]:
        """The pairs of children in a largest match."""
        start = 0
        while start < min(len(a), len(b)) and a[start].kind == b[start].kind:
            start += 1
        pairs = list(zip(a[:start], b[:start], strict=True))
        a, b = a[start:], b[start:]
        if not a or not b:
            return pairs
        if len(a) > 1 and len(a) * len(b) > CELLS:
            half = len(a) // 2
            first = self._rows(a[:half], b)[-1]
            rest = self._rows(a[half:][::-1], b[::-1])[-1][::-1]
            cut = int(np.argmax(first + rest))
            return pairs + self._aligned(a[:half], b[:cut]) + self._aligned(a[half:], b[cut:])
        rows = self._rows(a, b, whole=True)
        found, i, j = [], len(a), len(b)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((a[i], b[j]))
        return pairs + found[::-1]

    def places(self, a: str, b: str) -> list[tuple[int, int]]:
        """Numbers of matched nodes of two shapes, roots first."""
        open_pairs = [(parse(a, self.kinds), parse(b, self.kinds))]
        if open_pairs[0][0].key != open_pairs[0][1].key:
            return []
        out = []
        for x, y in open_pairs:
            out.append((x.place, y.place))
            open_pairs.extend(self._aligned(x.children, y.children))
        return out
