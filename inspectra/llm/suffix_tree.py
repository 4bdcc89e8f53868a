"""Suffix trees of symbol sequences: Ukkonen's construction, and the length of the
longest common extension of two places in constant time."""

from __future__ import annotations

import numpy as np

#: Entries of a tour that are summed up in one minimum.
_BLOCK = 16


class Minima:
    """Least entry of a range in constant time: minima from both ends inside
    blocks, and a sparse table over the blocks."""

    def __init__(self, x: np.ndarray):
        full = np.full(len(x) + -len(x) % _BLOCK, np.iinfo(np.int64).max)
        full[: len(x)] = x
        rows = full.reshape(-1, _BLOCK)
        self.x = full
        self.ahead = np.minimum.accumulate(rows, axis=1).ravel()
        self.back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [rows.min(axis=1)]
        step = 1
        while 2 * step <= len(rows):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def between(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least entries from ``lo`` to ``hi``, both included."""
        first, last = lo // _BLOCK, hi // _BLOCK
        out = np.minimum(self.back[lo], self.ahead[hi])
        same = np.flatnonzero(first == last)
        if len(same):
            at = np.minimum(lo[same, None] + np.arange(_BLOCK), hi[same, None])
            out[same] = self.x[at].min(axis=1)
        far = np.flatnonzero(last - first > 1)
        if len(far):
            a, b = first[far] + 1, last[far]
            level = np.frexp((b - a).astype(float))[1] - 1
            for k in np.unique(level).tolist():
                of = level == k
                some = far[of]
                row = self.table[k]
                out[some] = np.minimum(out[some], np.minimum(row[a[of]], row[b[of] - (1 << k)]))
        return out


class SuffixTree:
    """The tree of ``symbols`` (numbers from 0 on) and an end mark below all."""

    def __init__(self, symbols: list[int]):
        self.s = [*symbols, -1]
        self._build()
        self._tour()

    def _build(self) -> None:
        s, n = self.s, len(self.s)
        start, end, link, kids = [0], [0], [0], [{}]
        node = edge = length = left = 0
        for i, c in enumerate(s):
            pending = 0
            left += 1
            while left:
                if not length:
                    edge = i
                below = kids[node]
                k = below.get(s[edge])
                if k is None:
                    below[s[edge]] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    kids.append(None)
                    if pending:
                        link[pending] = node
                        pending = 0
                else:
                    at = start[k]
                    size = end[k] - at
                    if length >= size:
                        edge += size
                        length -= size
                        node = k
                        continue
                    if s[at + length] == c:
                        if pending:
                            link[pending] = node
                        length += 1
                        break
                    split, leaf = len(start), len(start) + 1
                    below[s[edge]] = split
                    start += (at, i)
                    end += (at + length, n)
                    link += (0, 0)
                    start[k] = at + length
                    kids += ({c: leaf, s[start[k]]: k}, None)
                    if pending:
                        link[pending] = split
                    pending = split
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - left + 1
        self._start, self._end, self._kids = start, end, kids

    def _tour(self) -> None:
        """Euler tour: depths of the nodes as a walk meets them, and where it meets
        the leaf of each suffix."""
        start, end, kids, n = self._start, self._end, self._kids, len(self.s)
        depth = [0] * len(start)
        walk, first, order = [], [0] * n, []
        todo = [0]
        while todo:
            v = todo.pop()
            if v < 0:
                walk.append(depth[~v])
                continue
            d = depth[v]
            below = kids[v]
            if below is None:
                first[n - d] = len(walk)
                order.append(n - d)
                walk.append(d)
                continue
            walk.append(d)
            for c in sorted(below, reverse=True):
                k = below[c]
                depth[k] = d + end[k] - start[k]
                todo += (~v, k)
        self.first = np.array(first, np.int64)
        self.minima = Minima(np.array(walk, np.int64))
        self.order = order

    def descending(self) -> list[int]:
        """Suffixes in the order of the alphabet turned round, the end mark still
        below all."""
        start, end, kids, n = self._start, self._end, self._kids, len(self.s)
        order, todo = [], [(0, 0)]
        while todo:
            v, d = todo.pop()
            below = kids[v]
            if below is None:
                order.append(n - d)
                continue
            for c in sorted(below):
                if c >= 0:
                    k = below[c]
                    todo.append((k, d + end[k] - start[k]))
            if -1 in below:
                k = below[-1]
                todo.append((k, d + end[k] - start[k]))
        return order

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that agree from the different places i and j on; the depth of the
        lowest common ancestor of their leaves."""
        a, b = self.first[i], self.first[j]
        return self.minima.between(np.minimum(a, b), np.maximum(a, b))
