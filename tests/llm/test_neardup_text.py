import random
import re

import numpy as np
import pytest
from data import SCHEMA, edge_documents, words

from inspectra.llm import neardup_text as nt

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(text)
    if 0 < len(w) < 5:
        return {tuple(w)}
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [(r[0], shingle_set(r[1])) for r in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), root(i) if i is not None else None, i is None or root(i) == i) for i, s in sets), key=repr)


def near_copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split(" ")
        for _ in range(rng.choice(edits)):
            w[rng.randrange(len(w))] = "edit%d" % rng.randrange(10**6)
        out.append(" ".join(w))
    return out


def corpus():
    rng = random.Random(9)
    texts = [words(rng, rng.randint(3, 200)) for _ in range(60)]
    for n, edits in ((30, (1, 2, 3)), (12, (0, 1, 4, 6)), (3, (2,)), (2, (1,))):
        base = words(rng, rng.randint(150, 260))
        texts += near_copies(rng, base, n, edits) + ([base.upper()] if n > 10 else [])
    rng.shuffle(texts)
    return [(i + 100, t, None, None, None) for i, t in enumerate(texts)] + edge_documents()


@pytest.mark.parametrize("block", [1024, 6])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nt, "BLOCK", block)
    rows = corpus()
    got = sorted((tuple(r) for r in nt.link(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == brute(rows)
    assert sum(r[0] != r[2] for r in got) > 30


def test_pigeonhole_guarantee():
    """Every pair within the distance shares a key, wherever its errors are."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 16, (500, nt.SYMBOLS), dtype=np.uint16)
    y = x.copy()
    for row in y:
        at = rng.choice(nt.SYMBOLS, nt.DISTANCE, replace=False)
        row[at] ^= 1
    assert (nt.chunk_keys(x) == nt.chunk_keys(y)).any(axis=1).all()


def test_empty(spark):
    assert nt.link(spark.createDataFrame([], SCHEMA)).count() == 0


def test_regular_texts_do_not_collide(spark):
    """Thue-Morse words, which polynomials modulo a power of two take for equal,
    and a very long text."""
    x, y = ("".join("ab"[(bin(i).count("1") + k) % 2] for i in range(1024)) for k in (0, 1))
    rows = [(1, x), (2, y), (3, " ".join([x] * 6)), (4, " ".join([y] * 6)), (5, "q w e r t y " * 500_000)]
    got = nt.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.kept and r.component_id == r.doc_id for r in got)
    assert {r.doc_id: r.n_shingles for r in got} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 6}
