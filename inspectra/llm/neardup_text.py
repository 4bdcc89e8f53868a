"""MinHash near-duplicates by a multi-index Hamming join.

A document is its set of distinct five-word shingles (ASCII letters lowered;
fewer than five words are one shingle).  Its signature has ``SYMBOLS`` b-bit
minima.  Signatures are cut into ``CHUNKS`` chunks; two signatures that differ
in at most ``DISTANCE`` symbols differ in at most one symbol of some chunk
(pigeonhole), so a document files each chunk once for each symbol left out, and
any such pair meets under an equal key.  Pairs that meet are held to the
signature distance, and links are confirmed on the full sets.  These counts are
for op8's similarity; ``SCHEMES`` has those for a lower one.

Documents with equal sets form a class that is filed once.  What the result
needs is components, so no pair is ever emitted: a bucket sends one edge for
each member that has a close partner in it, the components of these edges are
the groups of candidates, and each group's sets are brought together once, to
confirm its close pairs and send one edge for each linked document.  Buckets and
groups of more than ``BLOCK`` documents are split into blocks, each pair of
blocks being one piece of bounded size.

Shingles are compared by 64-bit keyed hashes of their words (see
:mod:`.textscan`), so a set is confirmed up to a chance of 2**-64 a pair of
shingles.

Edge cases: null and empty texts have no shingles and link with nothing; very
long texts are a block of their own, in memory linear in their length; a
null id (or text that is no number) links with nothing and is kept; rows that repeat an id are one document
and share its component; an empty table gives an empty result.  Only the named
columns are read, so extra columns never clash.
"""

from __future__ import annotations

from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, components, free_shuffles
from .quality import _salted, _twice
from .textscan import Words, blocks, gram_hashes, inside_documents, mix

SHINGLE, PERCENT = 5, 85
#: Signature: minima, bits of each, chunks, errors enumerated in a chunk.
SYMBOLS, BITS, CHUNKS, CHUNK_ERRORS = 40, 16, 9, 1
#: Distance up to which every pair is sure to meet: at a similarity of 0.85 six
#: symbols differ on average, and more than 17 about 6 times in a million pairs.
DISTANCE = CHUNKS * (CHUNK_ERRORS + 1) - 1
BLOCK = 1024
_U = np.uint64


class Scheme(NamedTuple):
    """What a least similarity takes: minima, chunks and the distance that is
    sure to meet."""

    percent: int
    symbols: int
    chunks: int

    @property
    def distance(self) -> int:
        return self.chunks * (CHUNK_ERRORS + 1) - 1


#: At a similarity of 0.80, 9.6 of 48 symbols differ on average, and more than
#: 23 about 3 times in a million pairs (more than 17 of 40: 304 times).
SCHEMES = [Scheme(PERCENT, SYMBOLS, CHUNKS), Scheme(80, 48, 12)]

_rng = np.random.default_rng(41)
_FACTORS = _rng.integers(1, 2**63, max(x.symbols for x in SCHEMES), dtype=np.uint64) * _U(2) + _U(1)


def scheme(percent: int) -> Scheme:
    """The scheme that finds all pairs of this similarity or more."""
    for x in SCHEMES:
        if x.percent <= percent <= 100:
            return x._replace(percent=percent)
    raise ValueError(f"no scheme for a similarity of {percent} percent")


def shingles(block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a block and the document of each, in order."""
    w = Words(block)
    h = w.hashes(lower=True)
    n_docs, counts = len(block.rows), w.counts()
    doc = np.repeat(np.arange(n_docs), counts)
    g = gram_hashes(h, SHINGLE)
    ok = np.flatnonzero(inside_documents(w.first, SHINGLE, len(h)))
    hashes, owner = [g[ok]], [doc[ok]]
    # A short document is one shingle, whatever its number of words.
    for k in range(1, SHINGLE):
        short = np.flatnonzero(counts == k)
        if len(short):
            hashes.append(mix(gram_hashes(h, k)[w.first[short]] ^ _U(k)))
            owner.append(short)
    value, owner = np.concatenate(hashes), np.concatenate(owner)
    later, _ = _twice(_salted(value, owner))
    value, owner = value[~later], owner[~later]
    order = np.argsort(owner, kind="stable")
    return value[order], owner[order]


def signatures(value: np.ndarray, first: np.ndarray, symbols: int = SYMBOLS) -> np.ndarray:
    """Symbols of every document that has shingles; ``first``: their places."""
    out = np.empty((len(first), symbols), np.uint16)
    for j in range(symbols):
        least = np.minimum.reduceat(value * _FACTORS[j], first)
        out[:, j] = (mix(least) >> _U(64 - BITS)).astype(np.uint16)
    return out


def chunk_keys(symbols: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """One key for every chunk and symbol left out of it."""
    keys = np.empty(symbols.shape, np.uint64)
    s = symbols.astype(np.uint64)
    cuts = np.linspace(0, symbols.shape[1], chunks + 1).astype(int)
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        for out in range(lo, hi):
            code = np.full(len(s), out + 1, np.uint64)
            for i in range(lo, hi):
                if i != out:
                    code = mix(code * _U(0x9E3779B97F4A7C15) + s[:, i])
            keys[:, out] = code
    return keys.view(np.int64)


def _measure(batches, symbols):
    for b in batches:
        ids = b.column(0)
        out = {n: [] for n in ("n", "s1", "s2", "sym")}
        for block in blocks(b.column(1)):
            value, owner = shingles(block)
            n = np.bincount(owner, minlength=len(block.rows))
            has = np.flatnonzero(n)
            first = np.searchsorted(owner, has)
            sym = np.zeros((len(n), symbols), np.uint16)
            s1, s2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(has):
                sym[has] = signatures(value, first, symbols)
                s1[has] = np.add.reduceat(mix(value), first)
                s2[has] = np.add.reduceat(mix(value * _U(0xD6E8FEB86659FD93) + _U(17)), first)
            out["n"].append(n.astype(np.int64))
            out["s1"].append(s1.view(np.int64))
            out["s2"].append(s2.view(np.int64))
            out["sym"] += [r.tobytes() for r in sym]
        cols = [np.concatenate(out[c]) if out[c] else np.zeros(0, np.int64) for c in ("n", "s1", "s2")]
        yield pa.RecordBatch.from_arrays([ids, *map(pa.array, cols), pa.array(out["sym"], pa.binary())], ["id", "n", "s1", "s2", "sym"])


def _matrix(column, symbols: int) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.uint16).reshape(-1, symbols)


def _file(batches, symbols, chunks):
    for b in batches:
        keys = chunk_keys(_matrix(b.column("sym"), symbols), chunks)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(b.column("id").to_numpy(), symbols))], ["key", "id"])


def _sets(batches):
    for b in batches:
        out = []
        for block in blocks(b.column(1)):
            value, owner = shingles(block)
            border = np.searchsorted(owner, np.arange(len(block.rows) + 1))
            out += [np.sort(value[s:e]).tobytes() for s, e in zip(border[:-1], border[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["id", "set"])


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the similarity, in whole numbers."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum()) if len(large) else 0
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _local(pairs: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray) -> np.ndarray:
    """Least id reachable within a group, over pairs of places in it."""
    comp = ids.copy()
    if pairs:
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        while True:
            before = comp.copy()
            low = np.minimum(comp[a], comp[b])
            np.minimum.at(comp, a, low)
            np.minimum.at(comp, b, low)
            if (comp == before).all():
                break
    return comp


def _close(sym: np.ndarray, blk: np.ndarray, cross: bool, distance: int):
    """Pairs of places whose signatures are within the distance, by rows."""
    n = len(sym)
    for s in range(0, n, 64):
        e = min(n, s + 64)
        differ = np.zeros((e - s, n), np.uint8)
        for j in range(sym.shape[1]):
            differ += sym[s:e, j, None] != sym[:, j]
        ok = (differ <= distance) & (np.arange(n) > np.arange(s, e)[:, None])
        if cross:
            ok &= blk[s:e, None] != blk
        a, b = np.nonzero(ok)
        yield a + s, b


def _meet(ids, sym, blk, cross, _sets, how):
    return _local([p for p in _close(sym, blk, cross, how.distance) if len(p[0])], ids)


def _verify(ids, sym, blk, cross, sets, how):
    """Local components of the confirmed links. A row's set is marked in one
    table over the group's shingles, against which all its close partners are
    counted at once; partners already reached are left out."""
    n = len(ids)
    values = [np.frombuffer(x, np.uint64) for x in sets]
    size = np.array([len(v) for v in values])
    if n == 2:
        linked = [(np.array([0]), np.array([1]))] if similar(*values, how.percent) and (not cross or blk[0] != blk[1]) else []
        return _local(linked, ids)
    every, flat = np.unique(np.concatenate(values), return_inverse=True)
    border = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(len(every), np.int32)
    links, comp = [], ids.copy()
    for a, b in _close(sym, blk, cross, how.distance):
        for i in np.unique(a):
            j = b[a == i]
            j = j[(comp[j] != comp[i]) & (100 * np.minimum(size[i], size[j]) >= how.percent * np.maximum(size[i], size[j]))]
            if not len(j):
                continue
            own = flat[border[i] : border[i + 1]]
            mark[own] = 1
            places = np.concatenate([flat[border[k] : border[k + 1]] for k in j])
            both = np.add.reduceat(mark[places], np.concatenate([[0], np.cumsum(size[j])[:-1]]))
            mark[own] = 0
            j = j[100 * both >= how.percent * (size[i] + size[j] - both)]
            if len(j):
                links.append((np.full(len(j), i), j))
                comp = _local(links[-1:] + [(np.array([0]), np.array([0]))], comp)
    return _local(links, ids)


def _components_of_groups(work, with_sets: bool, how: Scheme):
    """Arrow function over rows sorted by (g, bi, bj): sends ``(id, comp)`` for
    each row that hangs on another one in its group."""
    shape = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        held: list[pa.RecordBatch] = []

        def emit(t: pa.Table, last: bool):
            g, bi, bj = (t.column(c).to_numpy() for c in ("g", "bi", "bj"))
            border = np.flatnonzero((np.diff(g) != 0) | (np.diff(bi) != 0) | (np.diff(bj) != 0)) + 1
            edges = np.concatenate([[0], border, [len(g)]]) if last else np.concatenate([[0], border])
            upto = int(edges[-1])
            out = [[], []]
            if upto:
                ids, blk = (t.column(c).to_numpy() for c in ("id", "blk"))
                sym = _matrix(t.column("sym").slice(0, upto), how.symbols)
                sets = t.column("set").slice(0, upto).to_pylist() if with_sets else None
                for s, e in zip(edges[:-1], edges[1:], strict=True):
                    if e - s < 2:
                        continue
                    comp = work(ids[s:e], sym[s:e], blk[s:e], bool(bi[s] != bj[s]), sets[s:e] if with_sets else None, how)
                    moved = comp != ids[s:e]
                    out[0].append(ids[s:e][moved])
                    out[1].append(comp[moved])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=shape)
            rest = t.slice(upto)
            held[:] = rest.combine_chunks().to_batches() if rest.num_rows else []

        for b in batches:
            for s in range(0, b.num_rows, 4096):
                yield from emit(pa.Table.from_batches([*held, b.slice(s, 4096)]), False)
        if held:
            yield from emit(pa.Table.from_batches(held), True)

    return run


def _blocks_of(rows: DataFrame) -> DataFrame:
    """Rows ``(g, id, size, ...)`` once for each pair of blocks that they are in."""
    return (
        rows.withColumn("nb", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("blk", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .withColumn("bi", F.least("blk", "other"))
        .withColumn("bj", F.greatest("blk", "other"))
        .drop("nb", "other", "size")
    )


def _in_groups(rows: DataFrame, work, with_sets: bool, how: Scheme) -> DataFrame:
    # A fixed number of partitions: the work is in the groups, not in their bytes.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.repartition(n, "g", "bi", "bj").sortWithinPartitions("g", "bi", "bj", "id").mapInArrow(_components_of_groups(work, with_sets, how), "a long, b long").distinct()
    )


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.
    Documents are linked from a similarity of ``percent`` in a hundred on."""
    how = scheme(percent)
    ws = Workspace(docs.sparkSession, "minhash")
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).try_cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = ws.save(texts.mapInArrow(partial(_measure, symbols=how.symbols), "id long, n long, s1 long, s2 long, sym binary"), "signatures")
    filled = signed.where("n > 0 and id is not null")
    classes = filled.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"))
    reps = ws.save(
        filled.join(classes, ["n", "s1", "s2"]).where("id = rep").dropDuplicates(["n", "s1", "s2"]).select("id", "sym"), "reps"
    )
    filed = reps.mapInArrow(partial(_file, symbols=how.symbols, chunks=how.chunks), "g long, id long")
    buckets = filed.groupBy("g").agg(F.count("*").alias("size")).where("size > 1")
    meetings = _blocks_of(filed.join(buckets, "g")).join(reps, "id")
    coarse = components(spark, ws, ws.save(_in_groups(meetings, _meet, False, how), "meetings"))
    groups = ws.save(coarse.select("id", F.col("component").alias("g")), "groups")
    free_shuffles(spark)

    # Sets of the documents that have a close partner, and of no others.
    sets = ws.save(texts.join(groups.select("id").hint("merge"), "id", "left_semi").mapInArrow(_sets, "id long, set binary").where("length(set) > 0").dropDuplicates(), "sets", "none")
    free_shuffles(spark)
    sizes = groups.groupBy("g").agg(F.count("*").alias("size"))
    held = _blocks_of(groups.join(sizes, "g")).join(reps, "id").join(sets, "id")
    comp = ws.save(components(spark, ws, ws.save(_in_groups(held, _verify, True, how), "links")), "components")
    ws.drop(sets)

    result = (
        signed.join(classes, ["n", "s1", "s2"], "left")
        .join(comp.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.coalesce("component", "rep")).alias("component"),
        )
    )
    # Rows that repeat an id share the least component among them.
    own = result.where("id is not null").groupBy("id").agg(F.min("component").alias("least"))
    out = ws.save(
        signed.select("id", F.col("n").alias("n_shingles")).join(own, "id", "left").select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("least", "id")).alias("component_id")), "result"
    )
    ws.clear(out)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
