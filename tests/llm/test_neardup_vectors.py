import numpy as np
import pytest

from inspectra.llm import neardup_vectors as nv

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=nv.THRESHOLD):
    """Links, components; rows are vectors of their own."""
    ok = [r for r in rows if r[0] is not None and r[1] and r[2] is not None and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    out = {id(r): [r[0], 0, r[0]] for r in rows}
    parent = {id(r): id(r) for r in ok}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ok):
        for b in ok[i + 1 :]:
            if a[2] != b[2] or len(a[1]) != len(b[1]):
                continue
            x, y = np.float32(a[1]).astype(float), np.float32(b[1]).astype(float)
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                out[id(a)][1] += 1
                out[id(b)][1] += 1
                parent[root(id(a))] = root(id(b))
    least_id = {}
    for r in ok:
        k = root(id(r))
        least_id[k] = min(least_id.get(k, r[0]), r[0])
    for r in ok:
        out[id(r)][2] = least_id[root(id(r))]
    return sorted(((a, n, c, a is not None and a == c) for a, n, c in out.values()), key=repr)


def planted(seed=0, groups=6, hot=40):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for g in range(groups):
        c = rng.normal(size=64)
        for _ in range(hot if g == 0 else rng.integers(1, 6)):
            v = c + rng.normal(size=64) * rng.choice([0.02, 0.08, 0.13, 0.2]) * np.linalg.norm(c) / 8
            rows.append((int(at), [float(x) for x in np.float32(v)], int(g % 3)))
            at += 1
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nv, "BLOCK", block)
    rows = planted()
    z = [0.0] * 64
    rows += [
        (900, None, 1),
        (901, z, 1),
        (902, [float("nan")] + z[1:], 1),
        (903, [None] + rows[0][1][1:], 0),
        (904, rows[0][1], None),
        (None, rows[0][1], 0),
        (905, rows[0][1], 0),
        (905, rows[0][1], 0),
        (906, rows[0][1][:32], 0),
        (907, [], 0),
        (908, [x * 1e30 for x in rows[0][1]], 0),
        (909, [1.0], 1),
        (910, [2.0], 1),
        (911, [-2.0], 1),
    ]
    got = sorted((tuple(r) for r in nv.link(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == brute(rows)


def test_recall_on_a_table(spark, sf_dir):
    """Pairs right above the threshold, many vectors: recall of links."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 64))
    rows = []
    for i, c in enumerate(base):
        d = rng.normal(size=64)
        d -= d @ c / (c @ c) * c
        cos = rng.uniform(0.9801, 0.999)
        other = c / np.linalg.norm(c) * cos + d / np.linalg.norm(d) * np.sqrt(1 - cos**2)
        rows += [(2 * i, [float(x) for x in c], 1), (2 * i + 1, [float(x) for x in other], 1)]
    got = nv.link(spark.createDataFrame(rows, SCHEMA)).where("n_links > 0").count()
    assert got >= 0.98 * len(rows)


def test_empty(spark):
    assert nv.link(spark.createDataFrame([], SCHEMA)).count() == 0
