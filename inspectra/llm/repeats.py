"""Exact repeats of fixed length across a corpus.

Units are bytes or words, a window is ``w`` consecutive units of one document.
The aim: every window that also starts earlier, in a document of smaller id (or,
where asked, earlier in the same document).  Two ways lead to *runs*, stretches
of neighbouring windows that may be repeated (a candidate run is headed by a hash
``h`` such that equal windows always lie in runs of one ``h``):

*Samples* (bytes).  A window's sample is the least hash among its ``gram``-byte
prefixes of positions: the first, sampled ranking round.  Positions whose sample
no other place holds are unique already and go no further.  Windows next to each
other that take one place as their sample form a run.

*Blocks* (words).  Non-overlapping blocks of ``block`` words are the index; every
rolling window of ``block`` words of every document probes it.  A hit in a later
document, extended both ways, is the run of all windows that hold the block.

1. *Whole runs.*  A run is named by 128 bits of the text that it spans.  One whose
   name stands earlier is repeated as a whole, one row for all its windows.  Where
   one ``h`` heads runs of several names, or a run meets itself, the first run of
   each name stays open: these hold the ends of maximal repeats.
2. *Positions* of open runs.  Bytes: prefix doubling.  A position's rank pair
   (rank of its prefix, rank at an offset of at most the prefix's length) is
   sorted by Spark, ranked anew (dense within a partition, the partition's number
   above), unique ranks are dropped; the next offset is larger, until the
   threshold (for 100 bytes the samples' prefix of 64 leaves one such round).
   Words: the 128-bit names of the windows are sorted likewise, once.  A position
   whose last name stands earlier starts a repeat.

The first run of a name speaks for all runs of the name, so step 2 sees every
distinct pair of equal windows; nothing is capped.  Copies that meet in one batch
are settled there, which leaves a hot key one row for each batch.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, free_shuffles
from .textscan import Block, Words, blocks, byte_gram_hashes, gram_hashes, inside_documents, joined, longer, mix, sliding_argmin

#: Rows that repeat an id are told apart by this much in their positions.
ORDINAL = 1 << 40
#: Bytes of the prefix that a position's first rank stands for (built up by
#: doubling in the task that reads the text).
START = 64
#: Hash slices, one after the other, in which positions and probes are sorted:
#: each holds this part of the rows on disk.
SLICES = 3
_U = np.uint64
_SPAN = pa.list_(pa.struct([("s", pa.int64()), ("n", pa.int64())]))
_RUN = pa.list_(pa.struct([(c, pa.int64()) for c in ("s", "n", "h", "e")]))
_RUN_SQL = "array<struct<s: long, n: long, h: long, e: long>>"
_SPAN_SQL = "array<struct<s: long, n: long>>"


@dataclass(frozen=True)
class Kind:
    """``unit``: bytes or words; ``w``: window; ``gram``: bytes of the samples'
    grams; ``own``: whether an earlier place in the same document counts;
    ``block``: words of the fixed blocks (at most half a window)."""

    unit: str
    w: int
    gram: int
    own: bool
    block: int = 0


class Units:
    """A block's units, hashes of their grams, and the documents' borders."""

    def __init__(self, block: Block, kind: Kind):
        self.kind, self.block = kind, block
        self.words = None if kind.unit == "byte" else Words(block)
        self.first = block.off if self.words is None else self.words.first
        self.n = int(self.first[-1])
        self._hashes: dict[int, np.ndarray] = {}

    def grams(self, k: int, lane: int = 0) -> np.ndarray:
        if self.words is None:
            return byte_gram_hashes(self.block.buf, k, lane)
        if lane not in self._hashes:
            self._hashes[lane] = self.words.hashes(lane=lane)
        return gram_hashes(self._hashes[lane], k, lane)

    def names(self, start: np.ndarray, stop: np.ndarray, have: np.ndarray | None = None, k: int = 0) -> np.ndarray:
        """Names of runs of at most w windows: two windows' texts cover one.
        Hashes of k units that are there already are built upon."""
        if not len(start):
            return np.zeros(0, np.uint64)
        w = self.kind.w
        g = longer(have, k, w) if have is not None else self.grams(w)
        return joined(joined(g[start], g[stop]), (stop - start).astype(np.uint64))

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, at, side="right") - 1

    def kept_bytes(self, doc: int, keep: np.ndarray | None) -> bytes:
        """What remains of a document: its kept bytes, or its kept words with
        single spaces between. ``keep`` is None where everything stays."""
        b = self.block
        s, e = b.off[doc], b.off[doc + 1]
        if self.words is None:
            return b.buf[s:e].tobytes() if keep is None else b.buf[s:e][keep].tobytes()
        i, j = self.first[doc], self.first[doc + 1]
        text = b.buf[s:e].tobytes()
        if keep is None:
            return b" ".join(text.split())
        start, end = self.words.start[i:j] - s, self.words.end[i:j] - s
        return b" ".join([text[x:y] for x, y in zip(start[keep], end[keep], strict=True)])


def _distinct(value: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, value) pairs, ordered by document."""
    order = np.lexsort((value, doc))
    v, d = value[order], doc[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    return v[new], d[new]


def _lists(value: np.ndarray, doc: np.ndarray, n: int) -> pa.Array:
    """One list for each of n documents; ``doc`` is ascending."""
    border = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(border), pa.array(value.view(np.int64)))


def _runs(u: Units):
    """Runs of the windows that take their sample at one place: first, last, and
    sample; and all grams. Two windows of a run are never equal, as equal windows
    take their sample at equal offsets."""
    w, k = u.kind.w, u.kind.gram
    if u.n < w:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = u.grams(k)
    at, ok = sliding_argmin(grams, w - k + 1), inside_documents(u.first, w, u.n)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | ~ok[:-1]
    # Windows of two documents never share a run: those across are left out.
    start = np.flatnonzero(new & ok)
    stop = np.flatnonzero(np.append(new[1:] | ~ok[1:], True) & ok)
    return start, stop, grams[at[start]], grams


def _first_of(value: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether an entry is the first of its value in its document."""
    order = np.lexsort((value, doc))
    v, d = value[order], doc[order]
    out = np.ones(len(v), bool)
    out[order[1:]] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    return out


def _scan(kind: Kind):
    """Number of units and digest of every document; bytes: its samples too."""

    def run(batches):
        for b in batches:
            parts = []
            for block in blocks(b.column("text")):
                u = Units(block, kind)
                n = len(block.rows)
                sha = [hashlib.sha256(u.kept_bytes(i, None)).hexdigest() for i in range(n)]
                part = [np.diff(u.first).astype(np.int64), sha]
                if not kind.block:
                    start, _, value, _ = _runs(u)
                    doc = u.document(start)
                    first = _first_of(value, doc)
                    own = _distinct(value[~first], doc[~first]) if kind.own else (value[:0], doc[:0])
                    part += [_lists(value[first], doc[first], n), _lists(*own, n)]
                parts.append(part)
            if not parts:
                continue
            cols = [pa.array(np.concatenate([p[0] for p in parts])), pa.array([x for p in parts for x in p[1]]), *(pa.concat_arrays([p[i] for p in parts]) for i in range(2, len(parts[0])))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), *cols], ["id", "th", "units", "sha", "samples", "own"][: 2 + len(cols)])

    return run


def _per_document(lists: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return np.repeat(np.arange(n), lens), lists.flatten().to_numpy(zero_copy_only=False)


def _member(value: np.ndarray, doc: np.ndarray, has: np.ndarray, has_doc: np.ndarray) -> np.ndarray:
    """Which (document, value) pairs are among the others."""
    if not len(has):
        return np.zeros(len(value), bool)
    order = np.lexsort((has, has_doc))
    has, has_doc = has[order], has_doc[order]
    every, place = np.unique(has, return_inverse=True)
    pool = has_doc * len(every) + place
    at = np.minimum(np.searchsorted(every, value), len(every) - 1)
    key = doc * len(every) + at
    pool = np.sort(pool)
    found = np.minimum(np.searchsorted(pool, key), len(pool) - 1)
    return (every[at] == value) & (pool[found] == key)


def _structs(doc: np.ndarray, n: int, kind: pa.ListType, fields) -> pa.ListArray:
    """One list of structs for each of n documents; ``doc`` is ascending."""
    border = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    inner = kind.value_type
    columns = [pa.array(np.ascontiguousarray(f).view(np.int64)) for f in fields]
    return pa.ListArray.from_arrays(pa.array(border), pa.StructArray.from_arrays(columns, fields=list(inner)))


def _block_runs(u: Units, doc: np.ndarray, coded: np.ndarray):
    """Runs of the windows that hold the blocks at the given places, each twice
    its place plus one if the document has the block elsewhere too; places past a
    document's end (of another row with its id) are left out."""
    kind, at = u.kind, u.first[doc] + (coded >> 1)
    ok = at + kind.block <= u.first[doc + 1]
    at, doc, more = at[ok], doc[ok], (coded[ok] & 1) > 0
    g = u.grams(kind.block) if len(at) else np.zeros(0, np.uint64)
    if more.any():
        every = _counted(u.first[hit := np.unique(doc[more])], np.maximum(np.diff(u.first)[hit] - kind.block + 1, 0))
        of = u.document(every)
        again = every[_member(g[every], of, g[at[more]], doc[more])]
        at = np.union1d(at, again)
        doc = u.document(at)
    start = np.maximum(at - (kind.w - kind.block), u.first[doc])
    stop = np.minimum(at, u.first[doc + 1] - kind.w)
    ok = stop >= start
    at, start, stop = at[ok], start[ok], stop[ok]
    order = np.argsort(start, kind="stable")
    return start[order], stop[order], g[at[order]]


def _find_runs(kind: Kind):
    """Candidate runs of each document. Where its own earlier text counts, a run
    that it holds before is settled at once (``own``: stretches of windows)."""

    def run(batches):
        for b in batches:
            row_of, shared = _per_document(b.column("shared"), b.num_rows)
            for block in blocks(b.column("text")):
                u, n = Units(block, kind), len(block.rows)
                if kind.block:
                    lo, hi = np.searchsorted(row_of, [block.rows[0], block.rows[-1] + 1])
                    start, stop, value = _block_runs(u, row_of[lo:hi] - block.rows[0], shared[lo:hi])
                    name = u.names(start, stop)
                else:
                    start, stop, value, grams = _runs(u)
                    d = u.document(start)
                    ok = _member(value, block.rows[d] if len(d) else d, shared.view(np.uint64), row_of)
                    start, stop, value = start[ok], stop[ok], value[ok]
                    name = u.names(start, stop, grams, kind.gram)
                doc = u.document(start)
                first = _first_of(joined(value, name), doc) if kind.own else np.ones(len(doc), bool)
                again, d = np.flatnonzero(~first), doc[~first]
                new = np.ones(len(again), bool)
                new[1:] = (start[again[1:]] != stop[again[:-1]] + 1) | (d[1:] != d[:-1])
                head, size = np.flatnonzero(new), (stop - start + 1)[again]
                total = np.add.reduceat(size, head) if len(head) else size
                own = _structs(d[head], n, _SPAN, (start[again[head]] - u.first[d[head]], total))
                start, stop, value, name, doc = (x[first] for x in (start, stop, value, name, doc))
                runs = _structs(doc, n, _RUN, (start - u.first[doc], stop - start + 1, value, name))
                part = b.slice(block.rows[0], n)
                out = pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "th", "ord", "text")), runs, own], ["id", "th", "ord", "text", "runs", "own"])
                yield out.filter(pa.array(np.diff(np.asarray(runs.offsets)) > 0))

    return run


def _places(lists: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and lengths of lists of runs."""
    lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    flat = lists.flatten()
    return np.repeat(np.arange(n), lens), flat.field("s").to_numpy(), flat.field("n").to_numpy()


def _counted(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...``, n[i] of them, for every i."""
    return np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _resolved(runs: DataFrame, own: bool, ws: Workspace) -> DataFrame:
    """Per document, of its runs (id, ord, s, n, h, e): those that are repeated
    as a whole, and those whose positions are looked at. ``h`` and ``e`` name a
    run: 64 bits of its head and 64 of all its text."""
    named = runs.groupBy("h", "e").agg(F.min("id").alias("lo"), F.max("ord").alias("ords"), F.count("*").alias("runs"))
    split = named.groupBy("h").agg(F.count("*").alias("names"))
    # A name of one run, alone under its head, matches nothing.
    named = ws.save(named.join(split, "h").where("names > 1 or runs > 1").drop("runs"), "names", "none")
    free_shuffles(runs.sparkSession)
    earlier = F.col("id") > F.col("lo")
    # Rows that repeat an id do not match each other, but each may match itself.
    again = (F.col("names") > 1) | (F.lit(own) & (F.col("ords") > 0))
    plan = (
        runs.join(named, ["h", "e"])
        .where(earlier | again)
        .groupBy("id", "ord")
        .agg(
            F.collect_list(F.when(earlier, F.struct("s", "n"))).alias("whole"),
            F.array_sort(F.collect_list(F.when(~earlier, F.struct("s", "n")))).alias("open"),
        )
    )
    plan = ws.save(plan, "plan")
    ws.drop(named)
    return plan


def lengths(w: int) -> list[int]:
    """Prefix lengths of the rounds: doubling up to w, the last step overlaps."""
    out = [START if w > START else max(1, w // 3)]
    while out[-1] < w or len(out) < 2:
        out.append(min(w, 2 * out[-1]))
    return out


_PAIR = pa.schema([(c, pa.int64()) for c in ("r1", "r2", "id", "at")] + [("also", pa.list_(pa.int64()))])
_PAIR_SQL = "r1 long, r2 long, id long, at long, also array<long>"
_NAMED = pa.schema([(c, pa.int64()) for c in ("r1", "r2", "id", "at")] + [("done", pa.bool_())])
_NAMED_SQL = "r1 long, r2 long, id long, at long, done boolean"


def _grouped(r1, r2, ids, at):
    """Order by (r1, r2, id, at), and where a new pair begins in it."""
    order = np.lexsort((at, ids, r2, r1))
    a, b = r1[order], r2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, new


def _packed(r1, r2, ids, at) -> pa.RecordBatch:
    """One row for each rank pair of a batch: its first position, and the other
    ones as a flat list (id, place, id, place...)."""
    order, new = _grouped(r1, r2, ids, at)
    head, rest = order[new], order[~new]
    size = 2 * (np.diff(np.append(np.flatnonzero(new), len(order))) - 1)
    border = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    flat = np.column_stack([ids[rest], at[rest]]).ravel()
    also = pa.ListArray.from_arrays(pa.array(border), pa.array(flat), mask=pa.array(size == 0))
    return pa.RecordBatch.from_arrays([*(pa.array(x[head]) for x in (r1, r2, ids, at)), also], schema=_PAIR)


def _settled(r1, r2, ids, at, own: bool) -> pa.RecordBatch:
    """Rows of the last round. What an earlier position of the batch repeats is
    done and travels under a key of its own; of each name only the positions of
    the least document go on (its first one, where its own places count)."""
    order, new = _grouped(r1, r2, ids, at)
    i, t = ids[order], at[order]
    group = np.cumsum(new) - 1
    done = i > i[new][group]
    if own and len(order):
        same = ~new
        same[1:] &= (i[1:] == i[:-1]) & (t[1:] >> 40 == t[:-1] >> 40)
        done |= same
    key1, key2 = r1[order], r2[order]
    own_key = mix(i.view(np.uint64) ^ mix(t.view(np.uint64))).view(np.int64)
    cols = np.where(done, own_key, key1), np.where(done, t, key2), i, t
    return pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(done)], schema=_NAMED)


def _open_positions(b: pa.RecordBatch, block: Block, u: Units, shifts=(0,)):
    """Places of the open windows of a block, each shift added; ids and coded
    places of the same."""
    row, s, n = _places(b.column("open").slice(block.rows[0], len(block.rows)), len(block.rows))
    need = np.zeros(u.n + 1, bool)
    at = _counted(u.first[row] + s, n)
    for x in shifts:
        need[at + x] = True
    at = np.flatnonzero(need)
    doc = u.document(at)
    ids, ords = b.column("id").to_numpy()[block.rows[0] + doc], b.column("ord").to_numpy()[block.rows[0] + doc]
    return at, ids, ords * ORDINAL + at - u.first[doc]


def _first_pairs(kind: Kind, part: int | None):
    """First rank pairs: names of the prefix at a position and at the first
    offset; where more rounds follow, for one slice of the hashes."""
    steps = lengths(kind.w)
    shifts = {0}
    for a, b in zip(steps[1:-1], steps[2:], strict=True):
        shifts |= {x + b - a for x in shifts}

    def run(batches):
        for b in batches:
            for block in blocks(b.column("text")):
                u = Units(block, kind)
                at, ids, coded = _open_positions(b, block, u, sorted(shifts))
                g = u.grams(steps[0])
                first = g[at]
                if part is not None:
                    ok = first % _U(SLICES) == part
                    first, at, ids, coded = first[ok], at[ok], ids[ok], coded[ok]
                if len(at):
                    args = first.view(np.int64), g[at + steps[1] - steps[0]].view(np.int64), ids, coded
                    yield _settled(*args, kind.own) if part is None else _packed(*args)

    return run


def _rerank(batches):
    """Rows sorted by rank pair: a new rank for every pair that two positions
    hold, and their positions. Unique ones are dropped."""
    number, last, waiting = TaskContext.get().partitionId() << 36, None, None
    for b in batches:
        if not b.num_rows:
            continue
        r1, r2, ids, at = (b.column(c).to_numpy() for c in ("r1", "r2", "id", "at"))
        also = b.column("also")
        more = pc.fill_null(pc.list_value_length(also), 0).to_numpy()
        new = np.ones(len(r1), bool)
        new[1:] = (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1])
        goes_on = last is not None and last == (r1[0], r2[0])
        new[0] = not goes_on
        group = np.cumsum(new)
        rank = number + group
        count = np.bincount(group, minlength=group[-1] + 1)
        twice = (count > 1) | (np.bincount(group, more, minlength=len(count)) > 0)
        if goes_on:
            twice[0] = True
        keep = twice[group]
        out = [[ids[keep]], [at[keep]], [rank[keep]]]
        if goes_on and waiting is not None:
            for col, v in zip(out, (*waiting, number), strict=True):
                col.append(np.array([v]))
        if more.any():
            pairs = also.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
            out[0].append(pairs[:, 0])
            out[1].append(pairs[:, 1])
            out[2].append(np.repeat(rank, more // 2))
        # The last group may go on in the next batch.
        tail = group[-1]
        if tail != 0 or not goes_on:
            waiting = None if twice[tail] else (ids[-1], at[-1])
        else:
            waiting = None
        last, number = (r1[-1], r2[-1]), int(rank[-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["id", "at", "rank"])


def _next_pairs(offset: int, last: bool, own: bool):
    """Rows (id, at, rank) sorted by position: pairs of the ranks at a place and
    at the offset from it. A place without a partner is unique."""

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        for b in chain(batches, (None,)):
            cols = held
            if b is not None:
                cols = [np.concatenate([x, b.column(c).to_numpy()]) for x, c in zip(held, ("id", "at", "rank"), strict=True)]
            ids, at, rank = cols
            if not len(ids):
                continue
            inside = at & (ORDINAL - 1)
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (at[1:] >> 40 != at[:-1] >> 40)
            doc = np.cumsum(new) - 1
            # One ascending axis: documents one after the other.
            axis = doc * (int(inside.max()) + offset + 2) + inside
            to = np.minimum(np.searchsorted(axis, axis + offset), len(axis) - 1)
            ok = axis[to] == axis + offset
            if b is not None:
                tail = (doc == doc[-1]) & (inside > inside[-1] - offset)
                ok &= ~tail
                held = [x[tail] for x in cols]
            if ok.any():
                args = rank[ok], rank[to[ok]], ids[ok], at[ok]
                yield _settled(*args, own) if last else _packed(*args)

    return run


def _window_rows(kind: Kind):
    """Names of the windows of the open runs."""

    def run(batches):
        for b in batches:
            for block in blocks(b.column("text")):
                u = Units(block, kind)
                at, ids, coded = _open_positions(b, block, u)
                if len(at):
                    yield _settled(*(u.grams(kind.w, lane)[at].view(np.int64) for lane in (0, 1)), ids, coded, kind.own)

    return run


def _repeated(own: bool):
    """Rows sorted by (r1, r2, id, at): the positions that are done, or whose
    pair an earlier one holds."""

    def run(batches):
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            r1, r2, ids, at = (b.column(c).to_numpy() for c in ("r1", "r2", "id", "at"))
            new = np.ones(len(r1), bool)
            new[1:] = (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1])
            goes_on = last is not None and last[:2] == (r1[0], r2[0])
            new[0] = not goes_on
            least = ids[np.maximum.accumulate(np.where(new, np.arange(len(r1)), 0))]
            if goes_on:
                upto = int(np.argmax(new)) if new.any() else len(new)
                least[:upto] = last[2]
            again = np.asarray(b.column("done")) | (ids > least)
            if own:
                ords = at >> 40
                same = ~new
                same[1:] &= (ids[1:] == ids[:-1]) & (ords[1:] == ords[:-1])
                same[0] = goes_on and last[3:] == (ids[0], ords[0])
                again |= same
            last = (r1[-1], r2[-1], least[-1], ids[-1], at[-1] >> 40)
            yield b.select(["id", "at"]).filter(pa.array(again))

    return run


def _cover(kind: Kind):
    """Removed units, their runs, and the digest of what remains."""

    def run(batches):
        for b in batches:
            for block in blocks(b.column("text")):
                u, n = Units(block, kind), len(block.rows)
                part = b.slice(block.rows[0], n)
                edge = np.zeros(u.n + 1, np.int64)
                for name in ("whole", "own"):
                    row, s, size = _places(part.column(name), n)
                    np.add.at(edge, u.first[row] + s, 1)
                    np.add.at(edge, u.first[row] + s + size - 1 + kind.w, -1)
                row, at = _per_document(part.column("marks"), n)
                np.add.at(edge, u.first[row] + at, 1)
                np.add.at(edge, u.first[row] + at + kind.w, -1)
                gone = np.cumsum(edge[:-1]) > 0
                # Runs of removed units end with their document.
                start = gone.copy()
                start[1:] &= ~gone[:-1]
                head = u.first[:-1][np.diff(u.first) > 0]
                start[head] = gone[head]
                stop = gone.copy()
                stop[:-1] &= ~gone[1:]
                tail = u.first[1:][np.diff(u.first) > 0] - 1
                stop[tail] = gone[tail]
                start, stop = np.flatnonzero(start), np.flatnonzero(stop)
                doc = u.document(start)
                spans = _structs(doc, n, _SPAN, (start - u.first[doc], stop - start + 1))
                total = np.concatenate([[0], np.cumsum(gone)])
                sha = [hashlib.sha256(u.kept_bytes(i, ~gone[u.first[i] : u.first[i + 1]])).hexdigest() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("th"), pa.array(total[u.first[1:]] - total[u.first[:-1]]), spans, pa.array(sha, pa.string())], ["id", "th", "removed", "spans", "kept_sha"]
                )

    return run


def _probes(kind: Kind, part: int):
    """Every rolling block of every document with a window, for one slice of the
    hashes. Those at multiples of the block length are the index. Equal blocks of
    a document are one row: four times the first place, plus 2 if there are
    others, plus 1 if one is in the index."""
    shape = pa.schema([(c, pa.int64()) for c in ("b", "id", "at")])

    def run(batches):
        for b in batches:
            ids = b.column("id").to_numpy()
            for block in blocks(b.column("text")):
                u = Units(block, kind)
                g = u.grams(kind.block)
                at = np.flatnonzero(inside_documents(u.first, kind.block, u.n) & (g % _U(SLICES) == part))
                doc = u.document(at)
                long = np.diff(u.first)[doc] >= kind.w if len(at) else np.zeros(0, bool)
                at, doc = at[long], doc[long]
                if not len(at):
                    continue
                value = g[at]
                order = np.argsort(joined(value, doc.astype(np.uint64)), kind="stable")
                v, d, t = value[order], doc[order], at[order]
                new = np.ones(len(v), bool)
                new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
                head = np.flatnonzero(new)
                inside = t - u.first[d]
                fixed = np.logical_or.reduceat(inside % kind.block == 0, head)
                more = np.diff(np.append(head, len(v))) > 1
                by = np.argsort(t[head], kind="stable")
                coded = (inside[head] * 4 + more * 2 + fixed)[by]
                yield pa.RecordBatch.from_arrays([pa.array(v[head][by].view(np.int64)), pa.array(ids[block.rows[d[head][by]]]), pa.array(coded)], schema=shape)

    return run


def _met():
    """Rows sorted by (b, id, at): places of the blocks that one document has in
    the index and a later one holds, from the first such document on. A block
    that may still be met holds back the places of one document at most."""
    shape = pa.schema([("id", pa.int64()), ("at", pa.int64())])

    def run(batches):
        last, live, kept = None, False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            b, ids, at = (batch.column(c).to_numpy() for c in ("b", "id", "at"))
            if kept is not None and last == b[0]:
                b, ids, at = (np.concatenate(x) for x in zip(kept, (b, ids, at), strict=True))
            new = np.ones(len(b), bool)
            new[1:] = b[1:] != b[:-1]
            first = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            none = np.iinfo(np.int64).max
            low = np.minimum.reduceat(np.where(at & 1 > 0, ids, none), first)
            high = ids[np.append(first[1:], len(b)) - 1]
            met = low < high
            if live and last == b[0]:
                met[0], low[0] = True, np.iinfo(np.int64).min
            ok = met[group] & (ids >= low[group])
            live, last, kept = bool(met[-1]), b[-1], None
            if not live:
                tail = (group == group[-1]) & (ids == ids[-1])
                kept = b[tail], ids[tail], at[tail]
            yield pa.RecordBatch.from_arrays([pa.array(ids[ok]), pa.array(at[ok] >> 1)], schema=shape)

    return run


def _block_hits(texts: DataFrame, kind: Kind, ws: Workspace) -> DataFrame:
    """``(id, shared)``: places of the blocks that are indexed in one document
    and probed by a later one. Index and probes of a slice are dealt by block
    once and met in sorted order."""
    found = None
    for part in range(SLICES):
        probes = texts.where("id is not null").select("id", "text").mapInArrow(_probes(kind, part), "b long, id long, at long")
        met = probes.repartition("b").sortWithinPartitions("b", "id", "at").mapInArrow(_met(), "id long, at long")
        hits = ws.save(met, "hits")
        free_shuffles(texts.sparkSession)
        found = hits if found is None else found.unionAll(hits)
    return found.groupBy("id").agg(F.collect_set("at").alias("shared"))


def _sampled(scan: DataFrame, ws: Workspace) -> DataFrame:
    """``(id, shared)``: samples that two documents hold, slice by slice."""
    found = None
    for part in range(SLICES):
        held = scan.where("id is not null").select("id", F.explode("samples").alias("h")).where(F.pmod("h", F.lit(SLICES)) == part)
        common = held.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h")
        got = ws.save(held.join(common, "h").groupBy("id").agg(F.collect_set("h").alias("some")), "shared")
        free_shuffles(scan.sparkSession)
        found = got if found is None else found.unionAll(got)
    return found.groupBy("id").agg(F.flatten(F.collect_list("some")).alias("shared"))


def _marks(kind: Kind, pieces: DataFrame, ws: Workspace) -> DataFrame:
    """``(id, ord, marks)``: the open positions whose window is repeated."""
    spark = pieces.sparkSession
    if kind.unit == "word":
        named = pieces.mapInArrow(_window_rows(kind), _NAMED_SQL)
    elif len(lengths(kind.w)) == 2:
        named = pieces.mapInArrow(_first_pairs(kind, None), _NAMED_SQL)
    else:
        steps = lengths(kind.w)
        ranked = None
        for part in range(SLICES):
            first = pieces.mapInArrow(_first_pairs(kind, part), _PAIR_SQL).repartition("r1", "r2").sortWithinPartitions("r1", "r2")
            ranks = ws.save(first.mapInArrow(_rerank, "id long, at long, rank long").withColumn("rank", F.col("rank") * SLICES + part), "ranks")
            free_shuffles(spark)
            ranked = ranks if ranked is None else ranked.unionAll(ranks)
        for i in range(1, len(steps) - 1):
            last = i == len(steps) - 2
            ordered = ranked.repartition("id").sortWithinPartitions("id", "at")
            named = ordered.mapInArrow(_next_pairs(steps[i + 1] - steps[i], last, kind.own), _NAMED_SQL if last else _PAIR_SQL)
            if not last:
                ranked = ws.save(named.repartition("r1", "r2").sortWithinPartitions("r1", "r2").mapInArrow(_rerank, "id long, at long, rank long"), "ranks")
    marks = ws.save(
        named.repartition("r1", "r2")
        .sortWithinPartitions("r1", "r2", "id", "at")
        .mapInArrow(_repeated(kind.own), "id long, at long")
        .groupBy("id", F.shiftright("at", 40).alias("ord"))
        .agg(F.collect_set(F.col("at").bitwiseAND(ORDINAL - 1)).alias("marks")),
        "marks",
    )
    free_shuffles(spark)
    return marks


def find(docs: DataFrame, kind: Kind, id_col: str, text_col: str, ws: Workspace) -> DataFrame:
    """One row per input row: ``id, th (hash of the text), units, removed,
    spans (s, n), kept_sha``.

    Null texts are empty; a null id matches nothing and nothing matches it; rows
    that repeat an id are documents of equal rank that do not match each other.
    """
    texts = docs.select(
        F.col(id_col).try_cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    lists = "" if kind.block else ", samples array<long>, own array<long>"
    scan = ws.save(texts.mapInArrow(_scan(kind), "id long, th long, units long, sha string" + lists), "scan")
    shared = _block_hits(texts, kind, ws) if kind.block else _sampled(scan, ws)
    names = scan.where("id is not null").select("id", "th", *(["own"] if lists else [])).dropDuplicates(["id", "th"])
    twice = names.groupBy("id").agg(F.sort_array(F.collect_list("th")).alias("ths")).where("size(ths) > 1")
    both = F.coalesce("shared", F.array().cast("array<long>"))
    hits = ws.save(
        names.join(shared, "id", "left")
        .withColumn("shared", F.array_union(both, "own") if lists else both)
        .where("size(shared) > 0")
        .join(twice, "id", "left")
        .select("id", "th", "shared", F.when(F.col("ths").isNull(), F.lit(0)).otherwise(F.array_position("ths", F.col("th")) - 1).cast("long").alias("ord")),
        "hits",
    )
    facts = ws.save(scan.select("id", "th", "units", "sha"), "facts")
    ws.clear(hits, facts)
    free_shuffles(docs.sparkSession)

    found = ws.save(texts.join(hits.hint("merge"), ["id", "th"]).mapInArrow(_find_runs(kind), f"id long, th long, ord long, text string, runs {_RUN_SQL}, own {_SPAN_SQL}"), "runs")
    ws.drop(hits)
    plan = _resolved(found.select("id", "ord", F.explode("runs").alias("r")).select("id", "ord", "r.*"), kind.own, ws)
    free_shuffles(docs.sparkSession)
    pieces = ws.save(found.select("id", "ord", "text").join(plan.where("size(open) > 0").select("id", "ord", "open").hint("merge"), ["id", "ord"]), "open")
    free_shuffles(docs.sparkSession)
    marks = _marks(kind, pieces, ws)
    ws.drop(pieces)

    done = (
        found.select("id", "th", "ord", "text", "own")
        .join(plan.where("size(whole) > 0").select("id", "ord", "whole").hint("merge"), ["id", "ord"], "left")
        .join(marks.hint("merge"), ["id", "ord"], "left")
        .where("size(own) > 0 or whole is not null or marks is not null")
        .mapInArrow(_cover(kind), f"id long, th long, removed long, spans {_SPAN_SQL}, kept_sha string")
        .dropDuplicates(["id", "th"])
    )
    out = ws.save(
        facts.join(done, ["id", "th"], "left").select(
            "id",
            "th",
            "units",
            F.coalesce("removed", F.lit(0)).cast("long").alias("removed"),
            F.coalesce("spans", F.array().cast(_SPAN_SQL)).alias("spans"),
            F.coalesce("kept_sha", "sha").alias("kept_sha"),
        ),
        "result",
    )
    ws.clear(out)
    free_shuffles(docs.sparkSession)
    return out


def cut(texts: pa.Array, spans: list, kind: Kind) -> list[bytes]:
    """What remains of texts once their spans are removed."""
    out = []
    for block in blocks(texts):
        u = Units(block, kind)
        for d, r in enumerate(block.rows):
            keep = np.ones(int(u.first[d + 1] - u.first[d]), bool)
            for x in spans[r] or ():
                keep[x["s"] : x["s"] + x["n"]] = False
            out.append(u.kept_bytes(d, keep))
    return out
