"""Suffix trees by Ukkonen's algorithm and longest common extensions in constant time.

The tree is built online, one symbol at a time, over a sequence of small whole numbers; an Euler tour of it lists string
depths, and the depth of the lowest common ancestor of two leaves, which is the longest common prefix of their
suffixes, is the least depth of the tour between them.  Of the tour only the least depth between neighbouring leaves
is kept, under a sparse table of minima over powers of two: n * log2(n) small integers.  Queries take arrays.
"""

from __future__ import annotations

import numpy as np


def ukkonen(s: list[int], size: int) -> tuple[list[int], list[int], dict[int, int]]:
    """(start, end) of the edge into each node and the children: node * size + symbol -> node.

    ``s`` holds numbers below ``size`` and ends with one that occurs nowhere else.  Node 0 is the root; leaves have the end
    len(s) and are made in the order of their suffixes.
    """
    n = len(s)
    start, end, link = [0], [0], [0]
    child: dict[int, int] = {}
    node = edge = length = remain = 0
    for i, c in enumerate(s):
        made = 0  # inner node that waits for its suffix link
        remain += 1
        while remain:
            if not length:
                edge = i
            key = node * size + s[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if made:
                    link[made] = node
                    made = 0
            else:
                begin = start[below]
                span = end[below] - begin
                if length >= span:
                    edge += span
                    length -= span
                    node = below
                    continue
                if s[begin + length] == c:
                    length += 1
                    if made:
                        link[made] = node
                    break
                split = len(start)
                child[key] = split
                start.append(begin)
                end.append(begin + length)
                link.append(0)
                start[below] = begin + length
                child[split * size + s[begin + length]] = below
                child[split * size + c] = split + 1
                start.append(i)
                end.append(n)
                link.append(0)
                if made:
                    link[made] = split
                made = split
            remain -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - remain + 1
    return start, end, child


def tour(start: list[int], end: list[int], child: dict[int, int], size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, least string depth of the tour between each and the one before).

    Children are visited in the order of their symbols, so the suffixes come out sorted.
    """
    keys = np.fromiter(child.keys(), np.int64, len(child))
    nodes = np.fromiter(child.values(), np.int64, len(child))
    order = np.argsort(-keys, kind="stable")  # the last child first: the stack turns them round
    parent = keys[order] // size
    nodes = nodes[order].tolist()
    first = np.searchsorted(-parent, -np.arange(len(start)), side="left").tolist()
    last = np.searchsorted(-parent, -np.arange(len(start)), side="right").tolist()
    suffixes, low = [], []
    stack, depths = [0], [0]
    least = 0  # least depth seen since the last leaf
    above = [0]
    while stack:
        v, up, d = stack.pop(), above.pop(), depths.pop()
        least = min(least, up)  # back at the parent before going down to v
        a, b = first[v], last[v]
        if a == b:
            suffixes.append(n - d)
            low.append(least)
            least = d
        else:
            for w in nodes[a:b]:
                stack.append(w)
                above.append(d)
                depths.append(d + end[w] - start[w])
    return np.array(suffixes, np.int64), np.array(low, np.int32)


class Extensions:
    """Longest common prefixes of the suffixes of ``s``, a sequence of numbers from 1; ``rank`` is their order."""

    def __init__(self, s: np.ndarray):
        n, size = len(s) + 1, int(s.max(initial=0)) + 1
        order, low = tour(*ukkonen([*s.tolist(), 0], size), size, n)
        self.rank = np.empty(n, np.int64)
        self.rank[order] = np.arange(n)
        self.length = n - 1
        self.minima = [low]
        width = 1
        while 2 * width <= n:
            below = self.minima[-1]
            self.minima.append(np.minimum(below[:-width], below[width:]))
            width *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes i and j (i and j differ; n is the empty suffix)."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b)  # minima over low[a..b]
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            m = self.minima[k]
            out[at] = np.minimum(m[a[at]], m[b[at] - (1 << int(k)) + 1])
        return out
