"""HDBSCAN over any number of rows (Campello, Moulavi and Sander 2013).

1. Core distances are exact neighbour distances between blocks (:mod:`.neighbours`).
2. Edges. Every block has a spanning tree by mutual reachability, its pivot
   included. Two points of two blocks have a way that is known: up both trees to the
   pivots, and from pivot to pivot by a tree of these; only shorter edges are kept,
   and of all that a task finds those that a spanning forest of its blocks needs.
   Together these edges keep all points connected at every distance at which they
   are connected at all. Pivots whose points have no shorter edge do not meet.
3. Clusters. Edges are taken by length in chunks of bounded size; a chunk merges
   components and carries, for each, a summary of fixed size: points, the density
   that they leave at, the best choice below. Merges of one length are one step, so
   the order of ties does not matter. Edges inside a component are dropped, the
   others are renamed for the next chunk.
4. The cluster of a point is the topmost chosen one above it, found by doubling
   pointers.

No row goes to the driver, and no task holds more than its partitions' blocks or a
chunk. Exact edges cost the square of the points in time (not on the disk) where the
triangle inequality tells nothing apart; the edges of a neighbour forest (``trees``)
are linear, and nearly as good.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import Tables, indexed
from .neighbours import ROWS, Blocks, blocks, cross, distances, forest_k, matrix, nearest_k, needed, pack

#: Edges of a chunk (about).
CHUNK = 1 << 18
#: Neighbours of a point in the graph of a forest.
GRAPH = 15
#: Density of points that coincide.
MOST_LAMBDA = 1e290
#: Rows of a piece of new points, and of fitted points, in an assignment; new rows
#: whose distances are held at once.
NEW_PIECE, FITTED_PIECE, HELD = 5_000, 5_000, 256
#: Edges between blocks that a task holds before it drops those it can do without.
HELD_EDGES = 1 << 20

_EDGE = "a long, b long, w double"


def spanning(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (ends, lengths) of a least spanning tree of a matrix of lengths."""
    n = len(w)
    ends, links, size = np.zeros(max(n - 1, 0), np.int64), np.zeros(max(n - 1, 0), np.int64), np.zeros(max(n - 1, 0))
    out, best, link, at = np.ones(n, bool), np.full(n, np.inf), np.zeros(n, np.int64), 0
    for i in range(n - 1):
        out[at] = False
        best[at] = np.inf
        closer = np.flatnonzero((w[at] < best) & out)
        best[closer] = w[at, closer]
        link[closer] = at
        at = int(best.argmin())
        ends[i], links[i], size[i] = at, link[at], best[at]
    return links, ends, size


def _reach(x: np.ndarray, cx: np.ndarray, y: np.ndarray, cy: np.ndarray) -> np.ndarray:
    return np.maximum(np.maximum(distances(x, y), cx[:, None]), cy)


def _ways(w: np.ndarray) -> np.ndarray:
    """Least possible longest step between any two of some places."""
    out, groups = np.zeros_like(w), [[i] for i in range(len(w))]
    a, b, size = spanning(w)
    for i in np.argsort(size, kind="stable").tolist():
        g, h = groups[a[i]], groups[b[i]]
        out[np.ix_(g, h)] = out[np.ix_(h, g)] = size[i]
        for v in h:
            groups[v] = g
        g += h
    return out


def _columns(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return matrix(t["vec"]), t["core"].to_numpy(), t["idx"].to_numpy()


def _edges(a: np.ndarray, b: np.ndarray, w: np.ndarray, **more: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "w": pa.array(w, pa.float64())} | {k: pa.array(v) for k, v in more.items()})


def spanning_forest(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    """Places of the edges of a least spanning forest of ``n`` points; of equal
    lengths the first come first. In rounds, each part takes its least edge."""
    order = np.argsort(w, kind="stable")
    a, b, at, part, taken = a[order], b[order], np.arange(len(w)), np.arange(n), []
    while len(at):
        x, y = part[a[at]], part[b[at]]
        apart = x != y
        at, x, y = at[apart], x[apart], y[apart]
        if not len(at):
            break
        least = np.full(n, len(w))
        for ends in (x, y):
            one = np.full(n, len(w))
            one[ends[::-1]] = at[::-1]
            least = np.minimum(least, one)
        some = np.flatnonzero(least < len(w))
        best = least[some]
        taken.append(np.unique(best))
        up = np.arange(n)
        up[some] = part[a[best]] + part[b[best]] - some
        # Two parts that take one edge: the lesser is the root.
        roots = some[(up[up[some]] == some) & (some < up[some])]
        up[roots] = roots
        while (up[up] != up).any():
            up = up[up]
        part = up[part]
    return order[np.concatenate(taken)] if taken else np.zeros(0, np.int64)


class _Crossing:
    """Edges between a task's blocks that are shorter than the way known between
    their ends (``up``: the longest step from a row to its pivot in its block's tree,
    ``ways``: the same between pivots), without those that a least spanning forest of
    all these blocks can do without."""

    def __init__(self, ways: np.ndarray):
        self.ways, self.trees, self.found, self.size, self.most = ways, {}, [], 0, HELD_EDGES

    def add(self, p: int, x: pa.Table, q: int, y: pa.Table) -> None:
        for name, t in ((p, x), (q, y)):
            if name not in self.trees:
                self.trees[name] = [c[t["link"].to_numpy() >= 0] for c in (t["idx"].to_numpy(), t["link"].to_numpy(), t["reach"].to_numpy())]
        (px, cx, ix), (py, cy, iy) = _columns(x), _columns(y)
        up_x = np.maximum(x["up"].to_numpy(), self.ways[x["pivot"][0].as_py(), y["pivot"][0].as_py()])
        up_y = y["up"].to_numpy()
        for s in range(0, len(ix), HELD):
            d = distances(px[s : s + HELD], py)
            i, j = np.nonzero(d < np.maximum(up_x[s : s + HELD, None], up_y))
            d, i = d[i, j], i + s
            w = np.maximum(np.maximum(d, cx[i]), cy[j])
            some = w < np.maximum(up_x[i], up_y[j])
            if some.any():
                self.found.append((ix[i[some]], iy[j[some]], w[some]))
                self.size += int(some.sum())
                if self.size > self.most:
                    self.reduce()

    def reduce(self) -> None:
        trees = list(self.trees.values())
        own = sum(len(t[0]) for t in trees)
        a, b, w = (np.concatenate(c) for c in zip(*trees, *self.found))
        names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
        kept = spanning_forest(ends[: len(a)], ends[len(a) :], w, len(names))
        kept = kept[kept >= own]
        self.found, self.size = [(a[kept], b[kept], w[kept])], len(kept)
        self.most = max(HELD_EDGES, 2 * self.size)

    def out(self):
        if self.found:
            self.reduce()
            yield from _edges(*self.found[0]).to_batches(max_chunksize=100_000)


def candidate_edges(b: Blocks, core: DataFrame, tables: Tables, near: DataFrame | None = None) -> DataFrame:
    """``a, b, w``: edges that hold a least spanning tree by mutual reachability.
    ``core`` has ``idx`` and ``core``. With neighbours ``idx, near`` no blocks meet:
    the edges are the neighbours' and those of the blocks' and pivots' trees, which
    keep the points connected, but not always by the least ways."""
    rows = b.rows.join(core, "idx")
    n = len(b.centres)
    pivot_core = {r.idx: r.core for r in core.where(F.col("idx").isin(b.points.tolist())).collect()}
    cores = np.array([pivot_core[i] for i in b.points.tolist()])
    shared = rows.sparkSession.sparkContext.broadcast((b.centres, cores, b.points))

    def own(t: pa.Table) -> pa.Table:
        """A block's tree with its pivot, which every row hangs on in the end."""
        x, c, idx = _columns(t)
        p = t["pivot"][0].as_py()
        places, pivot_cores, points = shared.value
        root = np.flatnonzero(idx == points[p])
        if len(root):
            order = np.concatenate([root, np.delete(np.arange(len(idx)), root)])
            x, c, idx = x[order], c[order], idx[order]
            t = t.take(pa.array(order))
        else:
            x, c, idx = np.vstack([places[p : p + 1], x]), np.append(pivot_cores[p], c), np.append(points[p], idx)
        links, ends, size = spanning(_reach(x, c, x, c))
        link, reach, up = np.full(len(idx), -1), np.zeros(len(idx)), np.zeros(len(idx))
        link[ends], reach[ends] = idx[links], size
        for i, j, w in zip(ends.tolist(), links.tolist(), size.tolist()):
            up[i] = max(up[j], w)
        skip = len(idx) - t.num_rows
        return t.append_column("link", pa.array(link[skip:], pa.int64())).append_column("reach", pa.array(reach[skip:])).append_column("up", pa.array(up[skip:]))

    fields = "idx long, vec array<double>, pivot int, block long, core double"
    trees = tables.save(rows.select("idx", "vec", "pivot", "block", "core").groupBy("block").applyInArrow(own, f"{fields}, link long, reach double, up double"), "trees")
    inner, least = np.zeros(n), np.full(n, np.inf)
    for r in trees.groupBy("pivot").agg(F.max("reach").alias("reach"), F.min("core").alias("core")).collect():
        inner[r.pivot], least[r.pivot] = r.reach, r.core
    live = np.flatnonzero(b.pieces > 0)
    between = _reach(b.centres[live], cores[live], b.centres[live], cores[live])
    ways = np.zeros((n, n))
    ways[np.ix_(live, live)] = _ways(between)
    known = np.maximum(np.maximum(inner[:, None], inner), ways)
    need = np.maximum(b.gaps(), np.maximum(least[:, None], least)) < known
    links, ends, size = spanning(between)
    pivots = rows.sparkSession.createDataFrame([(int(b.points[live[i]]), int(b.points[live[j]]), float(w)) for i, j, w in zip(links, ends, size)], _EDGE)
    inside = trees.where("link >= 0").select(F.col("idx").alias("a"), F.col("link").alias("b"), F.col("reach").alias("w"))
    if near is None:
        packs = pack(trees, tables, "pivot")
        way = rows.sparkSession.sparkContext.broadcast(ways)
        between_blocks = cross(*needed(b, packs, need), lambda: _Crossing(way.value), _EDGE)
    else:
        pairs = near.select(F.col("idx").alias("a"), F.explode("near").alias("n")).select("a", F.col("n.j").alias("b"), F.col("n.d").alias("d"))
        of = lambda c: core.select(F.col("idx").alias(c), F.col("core").alias(f"core_{c}"))
        between_blocks = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", F.greatest("d", "core_a", "core_b").alias("w"))
    edges = tables.save(inside.unionByName(pivots).unionByName(between_blocks), "edges")
    if near is None:
        tables.drop(packs)
    return edges


_STEP = pa.schema(
    [("kind", pa.string()), ("id", pa.int64()), ("to", pa.int64()), ("size", pa.int64()), ("x", pa.float64()), ("y", pa.float64()), ("flag", pa.bool_()), ("members", pa.list_(pa.int64()))]
)
_STEP_SQL = "kind string, id long, to long, size long, x double, y double, flag boolean, members array<long>"


class Merger:
    """Components that a chunk of edges touches, and what they become.

    A component below ``least`` points is a list of them. From then on it is a
    chain: it has an id, the sum of the densities at which points left it (``x``),
    the best stability of the clusters below it (``y``) and whether there are any
    (``flag``)."""

    def __init__(self, states: list[dict], least: int, n: int):
        self.least, self.n, self.out = least, n, []
        self.state = {s["id"]: (s["size"], s["to"], s["x"], s["y"], s["flag"], s["members"]) for s in states}
        self.root: dict[int, int] = {}
        self.touched: set[int] = set()

    def find(self, v: int) -> int:
        root, r = self.root, v
        while (up := root.get(r, r)) != r:
            r = up
        while (up := root.get(v, v)) != r:
            root[v], v = r, up
        return r

    def emit(self, kind: str, id_: int, to: int | None = None, size: int | None = None, x: float | None = None, y: float | None = None, flag: bool | None = None, members=None) -> None:
        self.out.append((kind, id_, to, size, x, y, flag, members))

    def merge(self, parts: list[int], w: float) -> None:
        """Components that edges of one length make one."""
        lam = min(1 / w, MOST_LAMBDA) if w > 0 else MOST_LAMBDA
        single = (1, None, 0.0, 0.0, False)
        states = [self.state.pop(p, None) or (*single, [p]) for p in parts]
        name, total = min(parts), sum(s[0] for s in states)
        chains = [s for s in states if s[1] is not None]
        loose = [m for s in states if s[1] is None for m in s[5]]
        if not chains and total < self.least:
            self.state[name] = (total, None, 0.0, 0.0, False, loose)
            return
        if len(chains) == 1:
            size, chain, x, y, flag, _ = chains[0]
            x += lam * (total - size)
        else:
            # Ids are unique: components of one least point differ in size.
            chain, x, y, flag = name * (self.n + 1) + total, lam * total, 0.0, bool(chains)
            for size, child, left, below, has, _ in chains:
                stability = left - lam * size
                chosen = not (has and below > stability)
                y += stability if chosen else below
                self.emit("cluster", child, chain, size, lam, stability, chosen)
        for p in loose:
            self.emit("point", p, chain, None, lam)
        self.state[name] = (total, chain, x, y, flag, None)

    def run(self, a: np.ndarray, b: np.ndarray, w: np.ndarray):
        order = np.argsort(w, kind="stable")
        a, b, w = a[order].tolist(), b[order].tolist(), w[order].tolist()
        known = set(a) | set(b)
        i = 0
        while i < len(w):
            length, parts = w[i], {}
            while i < len(w) and w[i] == length:
                x, y = self.find(a[i]), self.find(b[i])
                if x != y:
                    x, y = min(x, y), max(x, y)
                    parts[x] = parts.get(x) or [x]
                    parts[x] += parts.pop(y, None) or [y]
                    self.root[y] = x
                i += 1
            for some in parts.values():
                self.merge(some, length)
        for v in known:
            r = self.find(v)
            if r != v:
                self.emit("name", v, r)
        for v, (size, chain, x, y, flag, members) in self.state.items():
            self.emit("state", v, chain, size, x, y, flag, members)
        return self.out


def _steps(rows, batch: int = 20_000):
    for i in range(0, len(rows), batch):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + batch]), _STEP)], schema=_STEP)


def condense(edges: DataFrame, n: int, least: int, tables: Tables, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Clusters ``(cluster, parent, birth, chosen)`` and points ``(idx, cluster,
    lam)``: where a point leaves the tree, and at which density."""

    def step(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        kind = t["kind"].to_numpy(zero_copy_only=False)
        e = t.filter(pa.array(kind == "edge"))
        a, b, w = (e[c].to_numpy() for c in ("id", "to", "x"))
        names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
        kept = spanning_forest(ends[: len(a)], ends[len(a) :], w, len(names))
        m = Merger(t.filter(pa.array(kind == "state")).to_pylist(), least, n)
        yield from _steps(m.run(a[kept], b[kept], w[kept]))

    blank = lambda *names: [F.lit(None).cast(t).alias(c) for c, t in (("size", "long"), ("y", "double"), ("flag", "boolean"), ("members", "array<long>")) if c not in names]
    left, states, outcomes, dropped = edges, None, [], []
    while True:
        # The next chunk of those that are left: most edges fall inside components soon.
        count = left.count()
        if outcomes and not count:
            break
        cut = left.agg(F.percentile_approx("w", chunk / count, 10_000)).first()[0] if count > chunk else None
        now = left if cut is None else left.where(F.col("w") <= cut)
        parts = now.select(F.lit("edge").alias("kind"), F.col("a").alias("id"), F.col("b").alias("to"), F.col("w").alias("x"), *blank())
        if states is not None:
            ends = now.select(F.explode(F.array("a", "b")).alias("id")).distinct()
            parts = parts.unionByName(states.join(ends, "id"))
        done = tables.save(parts.select(*_STEP.names).repartition(1).mapInArrow(step, _STEP_SQL), "step")
        outcomes.append(done.where("kind in ('cluster', 'point')"))
        if cut is None:
            break
        # Components that the chunk touched have a new state, the others keep theirs.
        fresh = done.where("kind = 'state'")
        if states is not None:
            others = states.join(ends, "id", "left_anti")
            fresh = fresh.unionByName(others.select(*fresh.columns))
        fresh = tables.save(fresh, "states")
        names = done.where("kind = 'name'").select("id", "to")
        after = left.where(F.col("w") > cut)
        for end in ("a", "b"):
            after = after.join(names.select(F.col("id").alias(end), F.col("to").alias("_to")), end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
        after = tables.save(after.where("a <> b").select("a", "b", "w"), "left")
        for old in dropped:
            tables.drop(old)
        left, states = after, fresh
        dropped = [left, states]
    every = outcomes[0]
    for o in outcomes[1:]:
        every = every.unionByName(o)
    clusters = every.where("kind = 'cluster'").select(F.col("id").alias("cluster"), F.col("to").alias("parent"), F.col("x").alias("birth"), F.col("flag").alias("chosen"))
    return clusters, every.where("kind = 'point'").select(F.col("id").alias("idx"), F.col("to").alias("cluster"), F.col("x").alias("lam"))


def topmost(clusters: DataFrame, tables: Tables) -> DataFrame:
    """``cluster, top``: the chosen cluster nearest the root above each (itself
    included), null where there is none. Pointers double each round."""
    t = tables.save(clusters.select("cluster", F.col("parent").alias("ptr"), F.when(F.col("chosen"), F.col("cluster")).alias("top")), "up")
    while not t.where("ptr is not null").isEmpty():
        u = t.select(F.col("cluster").alias("ptr"), F.col("ptr").alias("next"), F.col("top").alias("above"))
        t = tables.save(t.join(u, "ptr", "left").select("cluster", F.col("next").alias("ptr"), F.coalesce("above", "top").alias("top")), "up")
    return t.select("cluster", "top")


def fit(rows: DataFrame, id_col: str, vec: str, min_cluster_size: int = 3, min_samples: int | None = None, block_rows: int = ROWS, chunk: int = CHUNK, trees: int | None = None) -> DataFrame:
    """``id, vec, core, cluster, probability, birth, most``: label (-1 is noise;
    clusters are numbered by their first row), strength, and of the label's cluster
    the density that it starts at and the greatest in it. Null vectors are left out.

    Exact, and so of square cost where no two pivots are far apart. With ``trees``
    neighbours and edges come from a forest instead, at linear cost."""
    tables = Tables(rows.sparkSession, "density")
    points = tables.save(indexed(rows.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("vec")).where("vec is not null").orderBy("id"), tables), "points")
    b = blocks(points, tables, block_rows)
    k = min(min_samples or min_cluster_size, b.count - 1)
    if k < 1:
        none = F.lit(None).cast("double")
        return points.select(F.col("id").alias(id_col), "vec", F.lit(0.0).alias("core"), F.lit(-1).alias("cluster"), F.lit(0.0).alias("probability"), none.alias("birth"), none.alias("most"))
    near = tables.save(nearest_k(b, k, tables) if trees is None else forest_k(points, max(k, GRAPH), tables, trees, block_rows), "near")
    core = tables.save(near.select("idx", F.get("near", F.least(F.lit(k), F.size("near")) - 1)["d"].alias("core")), "core")
    edges = candidate_edges(b, core, tables, None if trees is None else near)
    clusters, left = condense(edges, b.count, min_cluster_size, tables, chunk)
    clusters = tables.save(clusters, "clusters")
    placed = tables.save(left.join(topmost(clusters, tables), "cluster", "left").select("idx", F.col("top").alias("cluster"), "lam"), "placed")
    final = placed.where("cluster is not null").groupBy("cluster").agg(F.min("idx").alias("first"), F.max("lam").alias("most")).join(clusters.select("cluster", "birth"), "cluster")
    final = indexed(final.orderBy("first"), tables, "label")
    strength = F.when(F.col("label").isNull(), 0.0).when(F.col("most") >= MOST_LAMBDA, 1.0).otherwise(F.least("lam", "most") / F.col("most"))
    labelled = placed.join(final, "cluster", "left").select("idx", F.coalesce("label", F.lit(-1)).cast("int").alias("cluster"), strength.alias("probability"), "birth", "most")
    out = points.join(core, "idx").join(labelled, "idx", "left").na.fill({"cluster": -1, "probability": 0.0})
    return tables.save(out.select(F.col("id").alias(id_col), "vec", "core", "cluster", "probability", "birth", "most"), "fitted")


def assign(rows: DataFrame, fitted: DataFrame, id_col: str, vec: str, min_samples: int = 3, new_piece: int = NEW_PIECE, fitted_piece: int = FITTED_PIECE) -> DataFrame:
    """``id, cluster_id, probability`` of new rows: label of the fitted point that
    is nearest by mutual reachability (of equal ones the nearest by distance), noise
    if that point is noise or its cluster starts only at a greater density. Null
    vectors are noise.

    Pieces of new rows meet pieces of fitted points; each meeting gives a row its
    nearest points and its best one by reachability without the row's own core
    distance, which is known when all meetings are."""
    size = fitted.count()
    if not size:
        raise ValueError("the model holds no fitted points")
    k = min(min_samples, size)
    tables = Tables(rows.sparkSession, "assign")
    keyed = tables.save(indexed(rows.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("vec")), tables), "new")
    n_new, n_fitted = max(1, -(-keyed.count() // new_piece)), max(1, -(-size // fitted_piece))
    deal = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = keyed.where("vec is not null").select("idx", "vec", F.pmod("idx", F.lit(n_new)).cast("int").alias("p")).withColumn("q", deal(n_fitted))
    right = fitted.select("vec", "core", "cluster", "birth", "most", F.pmod(F.xxhash64("vec", "core"), F.lit(n_fitted)).cast("int").alias("q")).withColumn("p", deal(n_new))
    point = pa.struct([("d", pa.float64()), ("core", pa.float64()), ("cluster", pa.int32()), ("birth", pa.float64()), ("most", pa.float64())])
    schema = pa.schema([("idx", pa.int64()), ("near", pa.list_(point)), ("best", point)])

    def part(x: pa.Table, y: pa.Table, at_y: np.ndarray) -> pa.Table:
        d, core = distances(matrix(x["vec"]), at_y), y["core"].to_numpy()
        m = min(k, d.shape[1])
        at = np.argpartition(d, m - 1, axis=1)[:, :m]
        reach = np.maximum(d, core)
        one = np.where(reach == reach.min(axis=1, keepdims=True), d, np.inf).argmin(axis=1)

        def points(d: np.ndarray, of: np.ndarray) -> pa.StructArray:
            t = y.select(["core", "cluster", "birth", "most"]).take(pa.array(of.ravel()))
            return pa.StructArray.from_arrays([pa.array(d.ravel()), *(pa.concat_arrays(c.chunks) for c in t.columns)], fields=list(point))

        near = pa.ListArray.from_arrays(pa.array(np.arange(0, m * len(d) + 1, m), pa.int32()), points(np.take_along_axis(d, at, axis=1), at))
        return pa.table({"idx": x["idx"], "near": near, "best": points(d[np.arange(len(d)), one], one)}, schema=schema)

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return schema.empty_table()
        at = matrix(y["vec"])
        return pa.concat_tables([part(x.slice(s, HELD), y, at) for s in range(0, x.num_rows, HELD)])

    kind = "struct<d: double, core: double, cluster: int, birth: double, most: double>"
    met = left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInArrow(run, f"idx long, near array<{kind}>, best {kind}")
    reach = lambda s: F.greatest(s["d"], s["core"])
    best = met.groupBy("idx").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"), F.min(F.struct(reach(F.col("best")).alias("r"), F.col("best.d").alias("d"), F.col("best").alias("b"))).alias("best"))
    best = best.withColumn("own", F.element_at("near", -1)["d"])
    # Within the own core distance all reachabilities are equal: the nearest such point.
    close = F.get(F.filter("near", lambda s: reach(s) <= F.col("own")), F.lit(0))
    best = best.select("idx", F.greatest("own", "best.r").alias("r"), F.when(F.col("best.r") <= F.col("own"), F.coalesce(close, F.col("best.b"))).otherwise(F.col("best.b")).alias("b"))
    lam = F.when(F.col("r") > 0, F.least(1 / F.col("r"), F.lit(MOST_LAMBDA))).otherwise(F.lit(MOST_LAMBDA))
    inside = (F.col("b.cluster") >= 0) & (lam > F.col("b.birth"))
    strength = F.when(F.col("b.most") >= MOST_LAMBDA, 1.0).otherwise(F.least(lam, F.col("b.most")) / F.col("b.most"))
    judged = best.select("idx", F.when(inside, F.col("b.cluster")).alias("cluster_id"), F.when(inside, strength).alias("probability"))
    out = keyed.select("id", "idx").join(judged, "idx", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("cluster_id", F.lit(-1)).cast("int").alias("cluster_id"), F.coalesce("probability", F.lit(0.0)).alias("probability"))
