"""Vectorised scanning of whole texts for Arrow-batched operators.

Texts arrive as Arrow string columns.  They are cut into blocks of bounded size
(always at document borders, never inside one), and each block is handled with
numpy: word borders, word hashes, n-gram hashes and sliding minima cost a few
passes over the block and no Python loop over words.

Hashes are keyed and non-linear: a span is read eight bytes at a time, each step
a bijection of what is read, and grams grow by doubling, each half mixed before
the halves meet.  Nothing is a polynomial in the bytes, so no regular text
(Thue-Morse words, long runs) makes two spans collide.  A lane has 64 bits;
wherever equality decides a result, two lanes (128 bits) or the bytes themselves
are compared.  Keys are constants, so every executor computes the same values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Word separators: space, tab, LF, VT, FF, CR.
SEPARATORS = b" \t\n\x0b\x0c\r"
#: Bytes of text handled at once; a longer document forms a block of its own.
BLOCK_BYTES = 1 << 20

_IS_SEP = np.zeros(256, bool)
_IS_SEP[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


#: Keys and multipliers of the two lanes.
_KEYS = _U(0x5EED1C0FFEE0DD01), _U(0x9D8F6B1A3C5E7F23)
_ODD = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
#: Low bytes of a word, by their number.
_LOW = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
#: Longer spans are hashed one by one with BLAKE2b.
_LONG_SPAN = 512


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Block:
    """Consecutive documents: ``rows`` are their places in the batch, ``buf``
    their bytes and ``off`` the borders (``len(rows) + 1`` values)."""

    __slots__ = ("rows", "buf", "off")

    def __init__(self, rows: np.ndarray, buf: np.ndarray, off: np.ndarray):
        self.rows, self.buf, self.off = rows, buf, off


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Null texts count as empty. Every row is in exactly one block."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    n = len(column)
    if n == 0:
        return
    off = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    size = np.diff(off)
    if column.null_count:
        size = np.where(np.asarray(column.is_valid()), size, 0)
    start = 0
    total = np.concatenate([[0], np.cumsum(size)])
    while start < n:
        stop = int(np.searchsorted(total, total[start] + limit, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        if (size[start:stop] == np.diff(off[start : stop + 1])).all():
            buf = data[off[start] : off[stop]]
        else:
            buf = np.concatenate([data[off[i] : off[i] + size[i]] for i in range(start, stop)])
        yield Block(np.arange(start, stop), buf, total[start : stop + 1] - total[start])
        start = stop


class Words:
    """Words of a block: byte borders ``start``/``end`` and ``first``, the
    place of each document's first word (``len(rows) + 1`` values)."""

    __slots__ = ("start", "end", "first", "block")

    def __init__(self, block: Block):
        buf, off = block.buf, block.off
        inside = ~_IS_SEP[buf]
        n = len(buf)
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        before[off] = False
        after = np.zeros(n + 1, bool)
        after[:-1] = inside
        after[off] = False
        self.block = block
        self.start = np.flatnonzero(inside & ~before[:-1])
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.first = np.searchsorted(self.start, off)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False, lane: int = 0) -> np.ndarray:
        """One 64-bit hash per word; equal words (after lower-casing A-Z if
        asked) have equal hashes wherever they stand."""
        buf = _LOWER[self.block.buf] if lower else self.block.buf
        return span_hashes(buf, self.start, self.end, lane)


def _loads(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, zeros behind the end."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    return np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of each byte span of ``buf``; spans of one length of at most eight
    bytes never collide."""
    size = end - start
    out = mix(size.astype(np.uint64) * _ODD[lane] + _KEYS[lane])
    words = _loads(buf)
    at = np.flatnonzero((size > 0) & (size <= _LONG_SPAN))
    h, place, left = out[at], start[at], size[at]
    while len(at):
        h = mix(h ^ (words[place] & _LOW[np.minimum(left, 8)])) + _KEYS[lane]
        done = left <= 8
        if done.any():
            out[at[done]] = h[done]
            more = ~done
            at, h, place, left = at[more], h[more], place[more], left[more]
        place, left = place + 8, left - 8
    for i in np.flatnonzero(size > _LONG_SPAN).tolist():
        digest = hashlib.blake2b(buf[start[i] : end[i]].tobytes(), digest_size=8, key=bytes([lane + 1]))
        out[i] = int.from_bytes(digest.digest(), "little")
    return out


def sequence_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of each span of 64-bit values."""
    return span_hashes(np.ascontiguousarray(values).view(np.uint8), 8 * start, 8 * end, lane)


def joined(a: np.ndarray, b: np.ndarray, lane: int = 0) -> np.ndarray:
    """One hash of two, in their order."""
    return mix(a * _ODD[lane] + b)


def _doubled(h: np.ndarray, have: int, k: int, lane: int) -> np.ndarray:
    """Hashes of k units from those of ``have`` units, lengths doubling (the
    last step overlaps)."""
    while have < k:
        step = min(have, k - have)
        h = joined(h[: len(h) - step], h[step:], lane)
        have += step
    return h


def gram_hashes(values: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hash of every run of k consecutive values; entry i covers i..i+k-1.
    The last k - 1 places are missing."""
    if len(values) < k:
        return np.zeros(0, np.uint64)
    return _doubled(mix(values + _KEYS[lane]), 1, k, lane)


def byte_gram_hashes(buf: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hash of every run of k consecutive bytes."""
    if len(buf) < k:
        return np.zeros(0, np.uint64)
    n = min(k, 8)
    first = np.array(_loads(buf)[: len(buf) - n + 1]) & _LOW[n]
    return _doubled(mix(first + _KEYS[lane]), n, k, lane)


def longer(h: np.ndarray, have: int, k: int, lane: int = 0) -> np.ndarray:
    """Hashes of k units from those of ``have`` of them."""
    return _doubled(h, have, k, lane) if len(h) > k - have else h[:0]


def inside_documents(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the n - k + 1 runs of k values stay in one document."""
    ok = np.ones(max(0, n - k + 1), bool)
    for shift in range(1, k):
        cut = first[1:-1] - shift
        cut = cut[(cut >= 0) & (cut < len(ok))]
        ok[cut] = False
    return ok


def sliding_argmin(x: np.ndarray, m: int) -> np.ndarray:
    """Place of the least of every m consecutive entries, the leftmost of equal
    ones (``len(x) - m + 1`` values), by running minima from both sides of
    blocks of m.  The low bits of an entry give way to its place."""
    n = len(x)
    if n < m:
        return np.zeros(0, np.int64)
    bits = m.bit_length() + 1
    right = _U(1 << (bits - 1))
    y = np.full(n + -n % m, np.iinfo(np.uint64).max, np.uint64)
    y[:n] = x
    y >>= _U(bits)
    y <<= _U(bits)
    y = y.reshape(-1, m)
    y |= np.arange(m, dtype=np.uint64)
    back = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()[: n - m + 1]
    # An entry of the right block loses to an equal one of the left block.
    ahead = np.minimum.accumulate(y | right, axis=1).ravel()[m - 1 : n]
    least = np.minimum(back, ahead)
    inside = np.tile(np.arange(m), len(y))[: n - m + 1]
    block = np.arange(n - m + 1) - inside
    block[((least & right) != 0) & (inside != 0)] += m
    return block + (least & (right - _U(1))).astype(np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
