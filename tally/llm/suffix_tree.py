"""Suffix trees of number sequences by Ukkonen's algorithm, and longest common extensions from them.

An Euler tour turns a common extension into the least depth between two places of the tour, and a table of block
minima answers that in constant time; many questions are answered at once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

END = -1  # smaller than every symbol

_BLOCK = 16


class SuffixTree:
    """The tree of ``symbols`` (numbers from 0) and an end mark behind them.

    ``rank[i]``: place of the suffix at i among all in lexicographic order, where the end mark comes first; its own
    suffix included, so there is one more than symbols. Building takes linear time and some 400 bytes a symbol, which
    are given back before the arrays of the tour are made.
    """

    def __init__(self, symbols: Sequence[int]):
        self.size = len(symbols) + 1
        self._tour(*_built([*symbols, END]))

    def _tour(self, start: list[int], end: list[int], kids: list[dict[int, int] | None]) -> None:
        n = self.size
        depth = [0] * len(start)
        first, rank, heights = [0] * n, [0] * n, []
        leaves = 0
        stack = [0]
        visit, push, pop = heights.append, stack.append, stack.pop
        while stack:
            node = pop()
            if node < 0:  # back from a child
                visit(depth[~node])
                continue
            children = kids[node]
            if children is None:
                at = n - depth[node]
                first[at], rank[at] = len(heights), leaves
                leaves += 1
                visit(depth[node])
                continue
            visit(depth[node])
            below, back = depth[node], ~node
            for symbol in sorted(children, reverse=True):
                child = children[symbol]
                depth[child] = below + end[child] - start[child]
                push(back)
                push(child)
        self.rank = rank
        self._first = np.array(first, np.int64)
        self._minima(np.array(heights, np.int32))

    def _minima(self, heights: np.ndarray) -> None:
        padded = np.full(-(-len(heights) // _BLOCK) * _BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(heights)] = heights
        blocks = padded.reshape(-1, _BLOCK)
        self._heights = padded
        self._from_begin = np.minimum.accumulate(blocks, axis=1).ravel()
        self._to_end = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self._levels = [blocks.min(axis=1)]
        step = 1
        while len(self._levels[-1]) > step:
            last = self._levels[-1]
            self._levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of the suffixes at ``i`` and ``j``, where i differs from j."""
        x, y = self._first[i], self._first[j]
        low, high = np.minimum(x, y), np.maximum(x, y)
        lb, hb = low // _BLOCK, high // _BLOCK
        out = np.minimum(self._to_end[low], self._from_begin[high])
        between = hb - lb - 1
        level = np.frexp(np.maximum(between, 1).astype(np.float64))[1] - 1  # floor of the logarithm
        for k in np.unique(level[between > 0]).tolist():
            at = np.flatnonzero((between > 0) & (level == k))
            row = self._levels[k]
            out[at] = np.minimum(out[at], np.minimum(row[lb[at] + 1], row[hb[at] - (1 << k)]))
        same = np.flatnonzero(between < 0)
        if len(same):
            a, b = low[same], high[same]
            least = self._heights[a]
            for step in range(1, _BLOCK):
                least = np.minimum(least, self._heights[np.minimum(a + step, b)])
            out[same] = least
        return out.astype(np.int64)


def _built(s: list[int]) -> tuple[list[int], list[int], list[dict[int, int] | None]]:
    """Edge starts and ends and children (by first symbol) of each node; node 0 is the root, leaves have no children."""
    n = len(s)
    start, end, link = [0], [0], [0]
    kids: list[dict[int, int] | None] = [{}]
    node = edge = length = waiting = 0
    for i, c in enumerate(s):
        waiting += 1
        last = 0  # inner node that waits for its suffix link
        while waiting:
            if not length:
                edge = i
            children = kids[node]
            child = children.get(s[edge])
            if child is None:
                children[s[edge]] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                kids.append(None)
                if last:
                    link[last] = node
                    last = 0
            else:
                begin = start[child]
                span = end[child] - begin
                if length >= span:  # walk down
                    edge += span
                    length -= span
                    node = child
                    continue
                if s[begin + length] == c:
                    length += 1
                    if last:
                        link[last] = node
                    break
                inner = len(start)
                children[s[edge]] = inner
                start += (begin, i)
                end += (begin + length, n)
                link += (0, 0)
                kids += ({s[begin + length]: child, c: inner + 1}, None)
                start[child] = begin + length
                if last:
                    link[last] = inner
                last = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return start, end, kids
