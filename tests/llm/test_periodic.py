import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from data import SCHEMA, edge_documents

from inspectra.llm import periodic, queries
from inspectra.llm.suffix_tree import Minima, SuffixTree


def brute_runs(w, least=24, repeats=3):
    """Every maximal stretch of each period; periods that are not smallest go."""
    found, n = {}, len(w)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            if length >= max(least, repeats * q) and not any(q % p == 0 and p < q and (s, length) == k[:2] for k, p in ((k, k[2]) for k in found)):
                found[s, length, q] = True
    return sorted(found, key=lambda r: (r[0], r[2]))


def words_of(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def brute(w):
    runs = brute_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_minima():
    rng = np.random.default_rng(1)
    for n in (1, 5, 16, 17, 400):
        x = rng.integers(0, 50, n)
        lo, hi = np.sort(rng.integers(0, n, (2, 300)), axis=0)
        assert Minima(x).between(lo, hi).tolist() == [x[a : b + 1].min() for a, b in zip(lo, hi)]


def test_tree_orders_and_extensions():
    rng = random.Random(2)
    for size, letters in ((1, 1), (30, 1), (60, 2), (200, 3), (150, 60)):
        s = [rng.randrange(letters) for _ in range(size)]
        t = SuffixTree(s)
        assert t.order == sorted(range(size + 1), key=lambda i: s[i:])
        assert t.descending() == sorted(range(size + 1), key=lambda i: [-x for x in s[i:]])
        i, j = np.array([(a, b) for a in range(size + 1) for b in range(a)][:3000] or [(0, 1)]).T

        def lce(a, b):
            n = 0
            while max(a, b) + n < size and s[a + n] == s[b + n]:
                n += 1
            return n

        assert t.common(i, j).tolist() == [lce(a, b) for a, b in zip(i, j)]


def test_runs_of_random_and_regular_words():
    rng = random.Random(3)
    fib, thue = [0], [0]
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    fib = b
    for _ in range(7):
        thue = thue + [1 - x for x in thue]
    cases = [fib, thue, [0] * 70, [0, 1] * 40 + [0], [0] * 30 + [1] * 30, []]
    for _ in range(150):
        w = [rng.randrange(rng.choice((2, 3, 9))) for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            p = [rng.randrange(4) for _ in range(rng.randrange(1, 14))]
            w += (p * 9)[: rng.randrange(1, 60)] + [rng.randrange(4) for _ in range(rng.randrange(6))]
        cases.append(w)
    for w in cases:
        assert [tuple(r) for r in periodic.runs_of(w).tolist()] == brute_runs(w)
        assert [tuple(r) for r in periodic.runs_of(w, 6, 3).tolist()] == brute_runs(w, 6)


def documents():
    rng = random.Random(5)
    rows = edge_documents()
    for i in range(100, 330):
        w = ["w%d" % rng.randrange(rng.choice((2, 5, 300))) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            p = ["p%d" % rng.randrange(6) for _ in range(rng.randrange(1, 20))]
            w += (p * 12)[: rng.randrange(10, 90)] + ["x"] * rng.randrange(3)
        rows.append((i, rng.choice((" ", "\n", "\t  ")).join(w) + rng.choice(("", "\n")), "en", "s", 1))
    return rows


def test_documents_against_brute_force(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = queries.run_columns(periodic.find_runs(queries.planted_periods(docs))).collect()
    want = [(i, *brute(words_of(i, t))) for i, t, *_ in rows]
    assert sorted(map(repr, (tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in got))) == sorted(map(repr, want))
    assert sum(w[1] > 0 for w in want) > 60
    assert periodic.find_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_collapsed_text_and_other_bounds(spark):
    rows = documents()[:60] + [(900, "é a b " * 9 + "end", "en", "s", 1)]
    out = periodic.find_runs(spark.createDataFrame(rows, SCHEMA).repartition(3), min_length=6, with_text=True).collect()
    texts = {repr(r[0]): r[1] for r in rows}
    for r in out:
        if [x[0] for x in rows].count(r.doc_id) > 1:
            continue
        w = words_of(None, texts[repr(r.doc_id)])
        runs = brute_runs(w, 6)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert [tuple(x) for x in r.runs] == runs and r.n_words == len(w) and r.n_dropped == len(gone)
        assert r.collapsed == " ".join(x for i, x in enumerate(w) if i not in gone)
    with pytest.raises(ValueError):
        periodic.find_runs(spark.createDataFrame(rows, SCHEMA), min_repeats=2)


def test_long_text_and_clashing_names(spark):
    """A text of megabytes that repeats throughout takes linear time."""
    long = " ".join("w%d" % (i % 37) for i in range(250_000)) + " last"
    rows = [("a", long, 1, "r"), ("b", None, 2, "s"), (None, "", 3, "t")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, n_words long, runs string")
    out = {r.doc_id: r for r in periodic.find_runs(docs).collect()}
    assert [tuple(x) for x in out["a"].runs] == [(0, 250_000, 37)] and out["a"].n_dropped == 250_000 - 37
    assert out["b"].runs == [] and out[None].collapsed_sha256 == hashlib.sha256(b"").hexdigest()


def test_query_against_brute_force(spark):
    at = "/root/testdata/sf0.001"
    texts = dict(tuple(r) for r in spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").collect())
    got = queries.QUERIES["op12_periodic_runs"](spark, at).collect()
    assert len(got) == len(texts) and sum(r.n_runs > 0 for r in got) > 5
    for r in got:
        assert tuple(r[c] for c in COLUMNS) == brute(words_of(r.doc_id, texts[r.doc_id]))
