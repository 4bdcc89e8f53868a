"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct units are concatenated and indexed by a suffix array (sorted
to the longest piece's length); every piece of the vocabulary is found by binary
search as a range of suffixes, whose positions are its edges.  Edges are sorted
by where they end and relaxed in that order.

The vocabulary is a BPE one with byte fallback, so the best path is the one that
merging by rank gives, not the one of largest score: a token may follow another
only if merging the two tokens' joined text gives exactly these two.  Under this
rule every prefix of a unit has exactly one last token, and relaxing finds it.

A unit is a run of word marks with the text up to the next one, which no piece
crosses; line feeds stand alone.  Edge cases: null and empty texts have no
tokens (and decode to null and empty); characters without a piece are their
UTF-8 bytes' pieces; a literal word mark decodes to a space; very long texts and
units are indexed alone, in memory linear in their length; repeated rows are
encoded alike; an empty table gives an empty result; other columns may have any
names (one called as a result column is replaced).
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Characters of units that are indexed at once; a longer unit stands alone.
INDEX_CHARS = 500_000
#: Units that a worker remembers; beyond it forgets them all (and token pairs beyond four times as many).
REMEMBER = 1_000_000
#: Places, as a power of two, for the token pairs asked for last.
PAIR_BITS = 21
#: Characters of documents handled at once.
CHUNK_CHARS = 4_000_000


class Vocabulary:
    """Pieces, their ranks and bytes; small (the model's size) and fixed."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        n = p.get_piece_size()
        self.pieces = [p.id_to_piece(i) for i in range(n)]
        self.byte_ids = [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        plain = [i for i in range(n) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        score = {i: p.get_score(i) for i in plain}
        ranks = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {self.pieces[i]: ranks[score[i]] for i in plain}
        self.bytes = [b"" if p.is_control(i) else self.pieces[i].encode() for i in range(n)]
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        # A piece that merging does not give back can never be a token.
        self.reached = [t for t in self.ids if self.merge(t) == [t]]

    def merge(self, text: str) -> list[str]:
        """Tokens of a text by merging: best rank first, then leftmost."""
        s = list(text)
        if len(s) > 40:
            return self._merge_long(s)
        rank = self.rank
        while len(s) > 1:
            best, at = None, -1
            for i in range(len(s) - 1):
                r = rank.get(s[i] + s[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            s[at : at + 2] = [s[at] + s[at + 1]]
        return s

    def _merge_long(self, s: list[str]) -> list[str]:
        n, rank = len(s), self.rank
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank[s[i] + s[i + 1]], i, s[i], s[i + 1]) for i in range(n - 1) if s[i] + s[i + 1] in rank]
        heapq.heapify(heap)
        live = [True] * n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if not live[i] or j >= n or s[i] != a or s[j] != b:
                continue
            s[i] = a + b
            live[j] = False
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (r := rank.get(s[x] + s[y])) is not None:
                    heapq.heappush(heap, (r, x, s[x], s[y]))
        return [t for t, ok in zip(s, live, strict=True) if ok]

    def to_ids(self, tokens: list[str]) -> list[int]:
        out = []
        for t in tokens:
            i = self.ids.get(t)
            out += [i] if i is not None else [self.byte_ids[b] for b in t.encode()]
        return out


class Encoder:
    """A worker's encoder: pieces as blocks of four codes, remembered units.

    Inside it word marks are spaces, one byte where the text is cut."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.tokens = [t for t in vocabulary.reached if " " not in t]
        texts = [t.replace(MARK, " ") for t in self.tokens]
        alphabet = sorted({ord(c) for t in texts for c in t})
        #: Places in the alphabet from 1 on; 0xFFFE for other characters.
        self.place = np.full(0x110000, 0xFFFE, np.uint16)
        self.place[alphabet] = np.arange(1, len(alphabet) + 1)
        self.token_len = np.array([len(t) for t in texts])
        self.token_id = np.array([vocabulary.ids[t] for t in self.tokens], np.int32)
        #: Of pieces of up to 4, 8, 16 ... characters: which, and the least and greatest blocks that they begin.
        self.classes = []
        blocks, below = 1, 0
        while below < self.token_len.max():
            which = np.flatnonzero((self.token_len > below) & (self.token_len <= 4 * blocks))
            low = np.zeros((len(which), 4 * blocks), np.uint16)
            for i, w in enumerate(which.tolist()):
                low[i, : len(texts[w])] = self._codes(texts[w])
            high = low.copy()
            high[np.arange(4 * blocks) >= self.token_len[which][:, None]] = 0xFFFF
            self.classes.append((which, self._quads(low), self._quads(high)))
            below, blocks = 4 * blocks, 2 * blocks
        self.pairs: dict[int, bool] = {}
        #: The last pair asked for in each place, and whether it may stand: 2 * pair + 1 or 2 * pair.
        self.recent = np.full(1 << PAIR_BITS, -1, np.int64)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _codes(self, text: str) -> np.ndarray:
        return self.place[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    @staticmethod
    def _quads(codes: np.ndarray) -> np.ndarray:
        """Rows of codes as numbers of four, that sort like them."""
        q = codes.astype(np.uint64).reshape(len(codes), -1, 4)
        return (q[..., 0] << np.uint64(48)) | (q[..., 1] << np.uint64(32)) | (q[..., 2] << np.uint64(16)) | q[..., 3]

    def _compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Whether merging the texts of two tokens gives these two."""
        at = (pairs * 0x9E3779B1 >> 30) & ((1 << PAIR_BITS) - 1)
        got = self.recent[at]
        new = np.flatnonzero(got >> 1 != pairs)
        if len(new):
            ask, inverse = np.unique(pairs[new], return_inverse=True)
            if len(self.pairs) > 4 * REMEMBER:
                self.pairs = {}
            known, n = self.pairs, len(self.tokens)
            said = np.empty(len(ask), np.int64)
            for i, p in enumerate(ask.tolist()):
                ok = known.get(p)
                if ok is None:
                    a, b = self.tokens[p // n], self.tokens[p % n]
                    ok = known[p] = self.v.merge(a + b) == [a, b]
                said[i] = ok
            got[new] = (2 * ask + said)[inverse]
            self.recent[at[new]] = got[new]
        return (got & 1).astype(bool)

    def _suffixes(self, codes: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The suffix array, sorted to the longest piece's length by doubling; for
        each length of 4, 8, 16 ... the keys that occur and where each begins."""
        n = len(codes)
        c = np.concatenate([codes, np.zeros(3, np.uint16)]).astype(np.uint64)
        key = (c[:n] << np.uint64(48)) | (c[1 : n + 1] << np.uint64(32)) | (c[2 : n + 2] << np.uint64(16)) | c[3:]
        levels, step = [], 4
        while True:
            order = np.argsort(key)
            key = key[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            begins = np.flatnonzero(first)
            levels.append((key[begins], np.append(begins, n)))
            if len(levels) == len(self.classes):
                return order, levels
            rank = np.zeros(n + step, np.int64)
            rank[order] = np.cumsum(first) - 1
            # What lies beyond the end is behind a separator, which no piece crosses.
            key = (rank[:n] << 32) + rank[step:]
            step *= 2

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and tokens of all occurrences of pieces."""
        order, levels = self._suffixes(codes)
        found, begin, number = [], [], []
        for k, (which, low, high) in enumerate(self.classes):
            lo, hi = np.searchsorted(levels[0][0], low), np.searchsorted(levels[0][0], high, side="right") - 1
            for keys, _ in levels[1 : k + 1]:
                lo = np.searchsorted(keys, (lo[:, 0::2] << 32) + lo[:, 1::2])
                hi = np.searchsorted(keys, (hi[:, 0::2] << 32) + hi[:, 1::2], side="right") - 1
            lo, hi = lo[:, 0], hi[:, 0]
            some = np.flatnonzero(lo <= hi)
            place = levels[k][1]
            found.append(which[some])
            begin.append(place[lo[some]])
            number.append(place[hi[some] + 1] - place[lo[some]])
        found, begin, number = np.concatenate(found), np.concatenate(begin), np.concatenate(number)
        return order[np.repeat(begin - np.cumsum(number) + number, number) + np.arange(number.sum())], np.repeat(found, number)

    def _match(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of units, one after the other, and how many each has."""
        size = np.fromiter(map(len, units), np.int64, len(units))
        codes = self._codes("\0".join(units) + "\0")
        border = np.cumsum(size + 1) - 1
        codes[border] = 0
        first = border - size
        n = len(codes)
        start, token = self._edges(codes)
        length = self.token_len[token]
        # A character without a piece of its own is an edge that joins nothing.
        single = np.zeros(n, bool)
        single[start[length == 1]] = True
        odd = np.flatnonzero((codes != 0) & ~single)
        none = len(self.tokens)
        start, token = np.concatenate([start, odd]), np.concatenate([token, np.full(len(odd), none)])
        end = start + np.concatenate([length, np.ones(len(odd), np.int64)])
        longest = int(size.max())
        depth = (np.arange(n) - np.repeat(first, size + 1))[end].astype(np.uint16 if longest < 1 << 16 else np.int64)
        by = np.argsort(depth, kind="stable")
        start, end, token = start[by], end[by], token[by]
        steps = np.searchsorted(depth[by], np.arange(1, longest + 2))
        last, back = np.full(n, -1), np.zeros(n, np.int64)
        last[first] = -2
        for a, b in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
            s, t = start[a:b], token[a:b]
            before = last[s]
            free = (before == -2) | (before == none) | ((t == none) & (before != -1))
            ask = np.flatnonzero(~free & (before >= 0))
            if len(ask):
                free[ask] = self._compatible(before[ask] * none + t[ask])
            e = end[a:b][free]
            last[e], back[e] = t[free], s[free]
        return self._read_back(codes, units, border, first, last, back)

    def _read_back(self, codes, units, border, first, last, back) -> tuple[np.ndarray, np.ndarray]:
        none = len(self.tokens)
        on_path, at = np.zeros(len(codes), bool), border[border > first]
        start = np.zeros(len(codes), bool)
        start[first] = True
        while len(at):
            on_path[at] = True
            at = back[at]
            at = at[~start[at]]
        ends = np.flatnonzero(on_path)
        token = last[ends]
        if (token < 0).any():
            raise AssertionError("a unit has no path")
        unit = np.searchsorted(border, ends)
        odd = np.flatnonzero(token == none)
        if not len(odd):
            return self.token_id[token], np.bincount(unit, minlength=len(units))
        size = np.ones(len(ends), np.int64)
        chars = {}
        for i in odd.tolist():
            u = unit[i]
            chars[i] = self.v.to_ids([units[u][int(ends[i] - first[u]) - 1].replace(" ", MARK)])
            size[i] = len(chars[i])
        place = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.int32)
        plain = token != none
        flat[place[plain]] = self.token_id[token[plain]]
        for i, x in chars.items():
            flat[place[i] : place[i] + len(x)] = x
        return flat, np.bincount(np.repeat(unit, size), minlength=len(units))

    def _learn(self, new: list[str]) -> None:
        # By length: relaxing takes as many steps as the longest unit has characters.
        new = sorted(new, key=len)
        found = [self._match(new[a:b]) for a, b in _ranges(list(map(len, new)), INDEX_CHARS)]
        size = np.concatenate([x for _, x in found])
        base, n = len(self.flat), len(self.known)
        self.start = np.concatenate([self.start, base + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, *(x for x, _ in found)])
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the texts, one after the other, and the borders between them."""
        if len(self.known) > REMEMBER:
            self.forget()
        units, border = split_units(texts)
        units = units.dictionary_encode()
        every, names = units.indices.to_numpy(), units.dictionary.to_pylist()
        new = [u for u in names if u not in self.known]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[every]
        size = self.size[at]
        total = np.concatenate([[0], np.cumsum(size)])
        flat = self.flat[np.repeat(self.start[at] - total[:-1], size) + np.arange(total[-1])]
        return flat, total[border]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Token ids of each text."""
        flat, cut = self.encode_array(pa.array(texts, pa.string()))
        return [flat[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def split_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts, with word marks as spaces, and the number of units
    before each text and after the last. A text gets a mark in front, unless it is
    null or empty."""
    filled = pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), MARK, " ")
    filled = pc.binary_join_element_wise(pc.if_else(pc.equal(pc.binary_length(filled), 0), "", " "), filled, "")
    _, offsets, data = filled.buffers()
    offsets = np.frombuffer(offsets, np.int32)[filled.offset : filled.offset + len(filled) + 1] if len(filled) else np.zeros(1, np.int32)
    low, high = int(offsets[0]), int(offsets[-1])
    if low == high:
        return pa.array([], pa.string()), np.zeros(len(filled) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[low:high]
    mark, feed = raw == 0x20, raw == 0x0A
    begins = feed.copy()
    begins[1:] |= feed[:-1]
    begins[0] |= mark[0]
    begins[1:] |= mark[1:] & ~mark[:-1]
    begins[offsets[:-1][offsets[:-1] < offsets[1:]] - low] = True
    at = np.flatnonzero(begins)
    cut = np.append(at, high - low).astype(np.int32) + np.int32(low)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(cut), data), np.searchsorted(at, offsets - low)


def decode(vocabulary: Vocabulary, ids) -> str:
    """Text of token ids: pieces and bytes joined, word marks as spaces, the
    mark that encoding put first left out."""
    text = b"".join(map(vocabulary.bytes.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
    return text[1:] if text.startswith(" ") else text


_encoders: dict[str, Encoder] = {}


def _encoder(vocabulary: Vocabulary, name: str) -> Encoder:
    """One encoder for each worker process and model."""
    if name not in _encoders:
        _encoders[name] = Encoder(vocabulary)
    return _encoders[name]


def _ranges(sizes: list[int], most: int):
    """Ranges of texts of bounded length; a longer text is a range of its own."""
    start, chars = 0, 0
    for i, n in enumerate(sizes):
        if i > start and chars + n > most:
            yield start, i
            start, chars = i, 0
        chars += n
    if sizes:
        yield start, len(sizes)


def encode(docs: DataFrame, text_col: str = "text", model: str = MODEL, check: bool = False) -> DataFrame:
    """``docs`` without the text, with ``token_ids`` (array of int; null for a
    null text) and, if asked, ``round_trip``: whether decoding gives the text."""
    vocabulary = Vocabulary(model)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rest = [c for c in docs.columns if c not in (text_col, "token_ids", "round_trip")]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    n = len(rest)

    def run(batches):
        enc = _encoder(shared.value, model)
        for b in batches:
            for s, e in _ranges(pc.fill_null(pc.utf8_length(b.column(n)), 0).to_pylist(), CHUNK_CHARS):
                texts = b.column(n).slice(s, e - s)
                flat, border = enc.encode_array(texts)
                lists = pa.ListArray.from_arrays(pa.array(border.astype(np.int32)), pa.array(flat), mask=texts.is_null())
                cols = [*(b.column(i).slice(s, e - s) for i in range(n)), lists]
                if check:
                    ids = (flat[x:y].tolist() for x, y in zip(border[:-1].tolist(), border[1:].tolist(), strict=True))
                    cols.append(pa.array([decode(enc.v, x) == (t or "").replace(MARK, " ") for x, t in zip(ids, texts.to_pylist(), strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(cols, [*rest, "token_ids", *["round_trip"] * check])

    comma = ", " if rest else ""
    (text,) = fresh(rest, "_text")
    return docs.select(*rest, F.col(text_col).alias(text)).mapInArrow(run, f"{fields}{comma}token_ids array<int>" + ", round_trip boolean" * check)


def decode_documents(encoded: DataFrame, ids_col: str = "token_ids", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``encoded`` with ``text_col`` in place of the token ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model))
    rest = [c for c in encoded.columns if c not in (ids_col, text_col)]
    fields = "".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}, " for c in rest)
    n = len(rest)

    def run(batches):
        for b in batches:
            texts = [None if x is None else decode(shared.value, x) for x in b.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(texts, pa.string())], [*rest, text_col])

    return encoded.select(*rest, ids_col).mapInArrow(run, f"{fields}{text_col} string")
