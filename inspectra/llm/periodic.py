"""Periodic runs: stretches of words that repeat with a period, and their removal.

Runs come from suffix trees. By the runs theorem every run holds, under one of the
two orders of the alphabet, a Lyndon root that is the longest Lyndon word from its
start; that word ends where the next smaller suffix starts. So each place gives one
candidate root an order, two longest common extensions (one in the tree of the
words, one in that of their reversal) extend it as far as its period lasts, and
what is long enough is a run.

Trees are grown only over stretches that can hold a run. In a run of
``MIN_LENGTH`` words and ``MIN_REPEATS`` periods at least, every ``GRAM`` words in a
row stand a period away again inside the run, so a run lies in a stretch whose
every word is covered by grams that its document holds twice; and no run could be
extended out of such a stretch, for then the longer run would lie in one. Grams are
told by hashes, which can only add stretches; words in the trees are the words
themselves.

A text is handled where it is read; nothing is shuffled.

Edge cases: null, empty and short texts have no runs and keep their words; very
long texts are read whole, in time that is linear in their words; runs that share
a start are ordered by period; repeated rows are handled alike; null ids are kept;
an empty table gives an empty result; other columns are never read and may have
any names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .suffix_tree import SuffixTree
from .textscan import Block, Words, blocks, gram_hashes, inside_documents, mix

#: Words and periods that a run has at least.
MIN_LENGTH, MIN_REPEATS = 24, 3
#: Words in a row that a run repeats. With 3 periods and 24 words, 8 is the most:
#: length >= 2 * period + 8 holds for every run.
GRAM = 8


def _next_smaller(order: list[int]) -> np.ndarray:
    """For each suffix but the empty one, the next place with a smaller suffix."""
    n = len(order)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    out, stack = [0] * n, [n - 1]
    for i in range(n - 2, -1, -1):
        r = rank[i]
        while rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out[: n - 1], np.int64)


def runs_of(symbols: list[int], min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """``start, length, period`` of every run, by start, then period."""
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    tree, turned = SuffixTree(symbols), SuffixTree(symbols[::-1])
    i = np.arange(n)
    found = []
    for order in (tree.order, tree.descending()):
        j = _next_smaller(order)
        right, left = np.zeros(n, np.int64), np.zeros(n, np.int64)
        at = np.flatnonzero(j < n)
        right[at] = tree.common(i[at], j[at])
        at = at[i[at] > 0]
        # Place i - 1 of the words is place n - i of their reversal.
        left[at] = turned.common(n - i[at], n - j[at])
        period = j - i
        length = period + left + right
        good = length >= np.maximum(min_length, min_repeats * period)
        found.append(np.stack([(i - left)[good], length[good], period[good]], axis=1))
    every = np.unique(np.concatenate(found), axis=0)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _stretches(words: Words, gram: int, least: int) -> list[tuple[int, int]]:
    """Word ranges covered by grams that their document holds twice."""
    n, first = len(words.start), words.first
    if n < least:
        return []
    doc = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    key = mix(gram_hashes(words.hashes(), gram) ^ mix(doc[: n - gram + 1] + np.uint64(1)))
    place = np.flatnonzero(inside_documents(first, gram, n))
    key = key[place]
    ranked = np.sort(key)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return []
    slot = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    at = place[twice[slot] == key]
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + gram, -1)
    held = np.zeros(n + 2, bool)
    held[1:-1] = np.cumsum(cover[:-1]) > 0
    border = np.zeros(n + 1, bool)
    border[first] = True
    start = np.flatnonzero(held[1:] & (~held[:-1] | border))
    end = np.flatnonzero(held[:-1] & (~held[1:] | border))
    return [(a, b) for a, b in zip(start.tolist(), end.tolist()) if b - a >= least]


def _collapsed(block: Block, words: Words, dropped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words joined by one space: bytes of all documents and their borders."""
    kept = np.flatnonzero(~dropped)
    start, end = words.start[kept], words.end[kept]
    doc = np.searchsorted(words.first, kept, side="right")
    buf = block.buf.copy()
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[start] += 1
    inside[end] -= 1
    mask = np.cumsum(inside[:-1], dtype=np.int8) > 0
    followed = np.flatnonzero(doc[1:] == doc[:-1])
    buf[end[followed]] = 32
    mask[end[followed]] = True
    size = np.concatenate([[0], np.cumsum(mask)])
    return buf[mask], size[block.off]


def _scan(block: Block, min_length: int, min_repeats: int, gram: int):
    """Runs by document of the block, words, and which words are dropped."""
    words = Words(block)
    dropped = np.zeros(len(words.start), bool)
    runs: dict[int, list] = {}
    for a, b in _stretches(words, gram, min_length):
        names: dict[bytes, int] = {}
        text = block.buf[words.start[a] : words.end[b - 1]].tobytes()
        at = words.start[a]
        symbols = [names.setdefault(text[s:e], len(names)) for s, e in zip((words.start[a:b] - at).tolist(), (words.end[a:b] - at).tolist())]
        found = runs_of(symbols, min_length, min_repeats)
        doc = int(np.searchsorted(words.first, a, side="right")) - 1
        for s, length, period in found.tolist():
            dropped[a + s + period : a + s + length] = True
            runs.setdefault(doc, []).append((a + s - int(words.first[doc]), length, period))
    return words, runs, dropped


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_repeats: int = MIN_REPEATS,
    with_text: bool = False,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``runs`` (an array of start, length,
    period in words, by start, then period), ``n_dropped`` (words of a run after its
    first period), ``collapsed_sha256`` of the words that are left, joined by one
    space, and with ``with_text`` those words as ``collapsed``."""
    gram = min(GRAM, max(1, min_length // 3))
    if min_repeats < 3 or min_length < 3:
        raise ValueError("a run has three periods and three words at least")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def scan(batches):
        for b in batches:
            n_words, found, gone, digest, left = [], [], [], [], []
            for block in blocks(b.column("_text")):
                words, runs, dropped = _scan(block, min_length, min_repeats, gram)
                buf, off = _collapsed(block, words, dropped)
                raw = buf.tobytes()
                n_words += words.counts().tolist()
                total = np.concatenate([[0], np.cumsum(dropped)])
                gone += np.diff(total[words.first]).tolist()
                for d in range(len(block.rows)):
                    found.append([{"start": s, "length": n, "period": p} for s, n, p in runs.get(d, ())])
                    part = raw[off[d] : off[d + 1]]
                    digest.append(hashlib.sha256(part).hexdigest())
                    if with_text:
                        left.append(part)
            columns = [b.column("_id"), pa.array(n_words, pa.int64()), pa.array(found, pa.list_(run)), pa.array(gone, pa.int64()), pa.array(digest)]
            names = [id_col, "n_words", "runs", "n_dropped", "collapsed_sha256"]
            if with_text:
                columns.append(pa.array(left, pa.binary()).cast(pa.string()))
                names.append("collapsed")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, n_dropped long, collapsed_sha256 string"
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(scan, schema + (", collapsed string" if with_text else ""))


def greatest(runs):
    """The run of greatest exact length over period; of equal ones the first."""
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.when(F.size(runs) > 0, F.aggregate(runs, F.get(runs, F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a)))
