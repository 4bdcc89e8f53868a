"""Embedding near-duplicates by cross-polytope hashing.

Every vector is turned by fast Hadamard rotations (random signs, then a
Walsh-Hadamard transform, three times); a hash is the signed coordinate of
largest magnitude.  A table joins ``k`` hashes, and a vector also enters the
buckets of its next best coordinates (multiprobe).  Pairs that meet in a bucket
are verified by their cosine in double precision.

Equal vectors of one label form a class that is hashed once and counts with its
size.  A bucket with more members than ``BLOCK`` is split into blocks, and each
pair of blocks is one group of bounded size, so a hot bucket spreads over many
tasks and no pair of rows is ever emitted: a group sends each member's number of
links and one edge to its local component.  A pair that shares several buckets
counts in the one of least key.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite
components, and rows with a null label or id, link with nothing; vectors of
different lengths never link; repeated rows are vectors of their own; ids and
labels are cast to long (text that is no number counts as null); an empty table
gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, components
from .textscan import mix

#: Hash tables, probes of each, rows of a block.
TABLES, PROBES, BLOCK = 4, 4, 1024
THRESHOLD = 0.98
_SEED = 20240229


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, in n log n steps."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def bucket_keys(x: np.ndarray, label: np.ndarray, k: int, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """``tables * probes`` bucket keys of each row of unit vectors."""
    n, d = x.shape
    full = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, full))
    padded[:, :d] = x
    rng = np.random.default_rng(_SEED)
    keys = np.empty((n, tables * probes), np.uint64)
    rows = np.arange(n)
    for t in range(tables):
        first, second, loss = [], [], []
        for _ in range(k):
            y = padded
            for _ in range(3):
                y = _hadamard(y * rng.choice([-1.0, 1.0], full))
            size = np.abs(y)
            top = np.argpartition(size, full - 2, axis=1)[:, -2:]
            swap = size[rows, top[:, 0]] > size[rows, top[:, 1]]
            best = np.where(swap, top[:, 0], top[:, 1])
            next_ = np.where(swap, top[:, 1], top[:, 0])
            first.append(2 * best + (y[rows, best] < 0))
            second.append(2 * next_ + (y[rows, next_] < 0))
            loss.append(size[rows, best] - size[rows, next_])
        # Subsets of hashes moved to their second choice, cheapest first.
        subsets = np.array([[(s >> i) & 1 for i in range(k)] for s in range(1 << k)], bool)
        cost = np.stack(loss, axis=1) @ subsets.T
        order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        for p in range(probes):
            use = subsets[order[:, p % order.shape[1]]]
            code = np.full(n, t + 1, np.uint64)
            for i in range(k):
                code = code * np.uint64(2 * full + 1) + np.where(use[:, i], second[i], first[i]).astype(np.uint64)
            keys[:, t * probes + p] = mix(code ^ mix(label.astype(np.int64).view(np.uint64) * np.uint64(1000003) + np.uint64(d)))
    return keys


def _unit(vectors: list[np.ndarray]) -> np.ndarray:
    x = np.stack(vectors).astype(np.float64)
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hash_rows(k: int):
    def run(batches):
        for b in batches:
            ids, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            by_size: dict[int, list[int]] = {}
            vectors: list[np.ndarray | None] = []
            for i, v in enumerate(b.column(2)):
                v = v.values if v.is_valid else None
                ok = v is not None and len(v) > 0 and v.null_count == 0 and labels[i] is not None and ids[i] is not None
                v = v.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0 if ok else None
                if v is not None and not (np.isfinite(v).all() and v.any()):
                    v = None
                vectors.append(v)
                if v is not None:
                    by_size.setdefault(len(v), []).append(i)
            out = {n: [] for n in ("id", "key", "unit", "buckets")}
            for at in by_size.values():
                x = _unit([vectors[i] for i in at])
                keys = bucket_keys(x, np.array([labels[i] for i in at]), k)
                for j, i in enumerate(at):
                    out["id"].append(ids[i])
                    out["key"].append(hashlib.blake2b(vectors[i].tobytes() + str(labels[i]).encode(), digest_size=16).digest())
                    out["unit"].append(x[j].tobytes())
                    out["buckets"].append(np.unique(keys[j].view(np.int64)))
            yield pa.RecordBatch.from_pydict(
                out, schema=pa.schema([("id", pa.int64()), ("key", pa.binary()), ("unit", pa.binary()), ("buckets", pa.list_(pa.int64()))])
            )

    return run


def _link_group(bucket: int, block: np.ndarray, cross: bool, ids, weight, x, buckets, least: float):
    """Links among the rows of one group; with ``cross`` only between its two
    blocks. Returns (weights of links, local component) per row."""
    n = len(ids)
    w, comp = np.zeros(n, np.int64), ids.copy()
    pairs_a, pairs_b = [], []
    for s in range(0, n, 128):
        near = x[s : s + 128] @ x.T >= least
        near &= np.arange(n) > np.arange(s, min(n, s + 128))[:, None]
        if cross:
            near &= block[s : s + 128, None] != block
        a, b = np.nonzero(near)
        a += s
        if not len(a):
            continue
        pairs_a.append(a)
        pairs_b.append(b)
        for c in range(0, len(a), 8192):
            i, j = a[c : c + 8192], b[c : c + 8192]
            both = (buckets[i][:, :, None] == buckets[j][:, None, :]) & (buckets[i] < bucket)[:, :, None]
            first = ~both.any(axis=(1, 2))
            np.add.at(w, i[first], weight[j[first]])
            np.add.at(w, j[first], weight[i[first]])
    if pairs_a:
        a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
        while True:
            before = comp.copy()
            low = np.minimum(comp[a], comp[b])
            np.minimum.at(comp, a, low)
            np.minimum.at(comp, b, low)
            if (comp == before).all():
                break
    return w, comp


def _link_groups(least: float, width: int):
    """Rows sorted by group; a group may cross the borders of batches."""
    out_schema = pa.schema([("id", pa.int64()), ("w", pa.int64()), ("comp", pa.int64())])

    def run(batches):
        held: list[pa.RecordBatch] = []

        def emit(t: pa.Table, last: bool):
            g = t.column("g").to_numpy()
            bi, bj = t.column("bi").to_numpy(), t.column("bj").to_numpy()
            border = np.flatnonzero((np.diff(g) != 0) | (np.diff(bi) != 0) | (np.diff(bj) != 0)) + 1
            edges = np.concatenate([[0], border, [len(g)]]) if last else np.concatenate([[0], border])
            upto = int(edges[-1])
            if upto:
                ids, m, blk = (t.column(c).to_numpy()[:upto] for c in ("id", "m", "blk"))
                unit = t.column("unit").combine_chunks() if isinstance(t.column("unit"), pa.ChunkedArray) else t.column("unit")
                keys = np.zeros((upto, width), np.int64) + np.iinfo(np.int64).max
                lists = t.column("buckets").combine_chunks()
                lens = np.asarray(pc.list_value_length(lists))[:upto]
                flat = lists.flatten().to_numpy()[: lens.sum()]
                keys[np.repeat(np.arange(upto), lens), np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
                rows = [[], [], []]
                for s, e in zip(edges[:-1], edges[1:], strict=True):
                    if e - s < 2:
                        continue
                    x = np.stack([np.frombuffer(unit[i].as_py(), np.float64) for i in range(s, e)]) if len({len(unit[i].as_py()) for i in range(s, e)}) == 1 else None
                    if x is None:
                        continue  # different lengths: a hash clash of labels, never a link
                    # Rows that lack a bucket hold the largest key, which no bucket has.
                    k = np.where(keys[s:e] == np.iinfo(np.int64).max, -1 - ids[s:e, None], keys[s:e])
                    w, comp = _link_group(int(g[s]), blk[s:e], bool(bi[s] != bj[s]), ids[s:e], m[s:e], x, k, least)
                    hit = (w > 0) | (comp != ids[s:e])
                    for col, v in zip(rows, (ids[s:e][hit], w[hit], comp[hit]), strict=True):
                        col.append(v)
                if rows[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in rows], schema=out_schema)
            rest = t.slice(upto)
            held[:] = rest.combine_chunks().to_batches() if rest.num_rows else []

        for b in batches:
            for s in range(0, b.num_rows, 4096):
                yield from emit(pa.Table.from_batches([*held, b.slice(s, 4096)]), False)
        if held:
            yield from emit(pa.Table.from_batches(held), True)

    return run


def link(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per input row: id, ``n_links``, ``component_id``, ``kept``."""
    spark = vectors.sparkSession
    ws = Workspace(spark, "vectors")
    rows = vectors.select(
        F.col(id_col).try_cast("long").alias("id"), F.col(label_col).try_cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("v")
    )
    n = rows.count()
    # So many joint hashes that random vectors share a bucket with few others.
    k = max(2, math.ceil(math.log(max(n, 2) / 16) / math.log(128)))
    hashed = ws.save(rows.mapInArrow(_hash_rows(k), "id long, key binary, unit binary, buckets array<long>"), "hashed")
    classes = hashed.groupBy("key").agg(F.min("id").alias("cid"), F.count("*").alias("m"))
    reps = ws.save(
        hashed.join(classes, "key").where("id = cid").dropDuplicates(["key"]).select("id", "m", "unit", "buckets"), "reps"
    )
    entries = reps.select("id", F.explode("buckets").alias("g"))
    sizes = entries.groupBy("g").agg(F.count("*").alias("n")).where("n > 1")
    blocked = (
        entries.join(sizes, "g")
        .withColumn("nb", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("blk", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .select("g", "id", "blk", F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"))
    )
    groups = (
        blocked.join(reps, "id")
        .select("g", "bi", "bj", "blk", "id", "m", "unit", "buckets")
        .repartition("g", "bi", "bj")
        .sortWithinPartitions("g", "bi", "bj")
    )
    found = ws.save(groups.mapInArrow(_link_groups(threshold, TABLES * PROBES), "id long, w long, comp long"), "found")
    comp = components(spark, ws, found.select(F.col("id").alias("a"), F.col("comp").alias("b")))
    links = found.groupBy("id").agg(F.sum("w").alias("w"))
    member = (
        hashed.select("id", "key")
        .join(classes, "key")
        .join(links.withColumnRenamed("id", "cid"), "cid", "left")
        .join(comp.withColumnRenamed("id", "cid"), "cid", "left")
        .select("id", (F.coalesce("w", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "cid").alias("component_id"))
    )
    # Rows that hashed to nothing have no class; both kinds of row stay as often as they came.
    alone = rows.select("id").join(hashed.select("id").distinct(), "id", "left_anti").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    mixed = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    twice = mixed.join(hashed.groupBy("id").agg(F.count("*").alias("h")), "id").where("h < n").select("id", F.explode(F.sequence(F.lit(1), (F.col("n") - F.col("h")).cast("int"))).alias("_")).select("id", F.lit(0).cast("long"), F.col("id"))
    out = ws.save(member.unionAll(alone).unionAll(twice), "result")
    ws.clear(out)
    return out.select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
