import re
from collections import Counter, defaultdict

from data import SCHEMA, edge_documents
from oracle import same

from inspectra.llm import divergence, queries


def brute(rows, min_docs=10, top=10):
    """The contract in plain Python; rows are (lang, source, text)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        n[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, d in docs[lang].items() if d >= min_docs)
        whole = Counter()
        for s in sources:
            whole.update({t: n[lang, s][t] for t in kept})
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[u] for u in kept) + 2 * len(kept)) for t in kept} if kept else {}  # noqa: E731, B023
        p, q = {s: share(n[lang, s]) for s in sources}, share(whole)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, f(p[s][t], q[t])) for t in kept if n[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def edge(spark):
    rows = [(i, t, lang, s, n) for i, t, lang, s, n in edge_documents()]
    some = "Ähre ähre THE the The_end x1y don't naïve"
    rows += [(100 + i, some + " w%s" % chr(97 + i % 3), "en", "src%d" % (i % 7), 1) for i in range(40)]
    rows += [(200, None, "xx", "only", 0), (201, "", "xx", "other", 0), (202, "!!", "yy", None, 0), (203, "lone", None, None, 0)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_edge_documents(spark):
    rows, docs = edge(spark)
    want = brute([(r[2], r[3], r[1]) for r in rows])
    assert rows_of(divergence.audit(docs)) == want
    assert any(r[0] == "xx" and r[2] == "pair" and r[4] == 0 for r in want)


def test_any_shape_of_the_cube(spark):
    rows, docs = edge(spark)
    want = brute([(r[2], r[3], r[1]) for r in rows], 2, 3)
    for block, slices in ((1, 10), (2, 25), (3, 10**6), (100, 40)):
        assert rows_of(divergence.audit(docs, min_docs=2, top=3, group_block=block, slice_rows=slices)) == want


def test_small_flushes_and_reads(spark, monkeypatch):
    """Sums are handed on and long texts are cut anywhere with the same result."""
    rows = [("en", "s%d" % (i % 3), "alpha beta gamma " * (i + 1) + "ä" * 50) for i in range(12)]
    docs = divergence.count_terms(spark.createDataFrame(rows, "lang string, source string, text string"))
    got = {(r.source, r.term): (r.n, r.docs) for r in docs.collect()}
    assert got["s0", "alpha"] == (1 + 4 + 7 + 10, 4) and got["s2", "ä" * 50] == (4, 4)
    monkeypatch.setattr(divergence, "READ_BYTES", 7)
    text = "one Two three_FOUR ünf\x00six ".encode() * 5
    assert [w for part in divergence._terms(text) for w in part] == re.findall(rb"[a-z\x80-\xff]+", text.lower())


def test_large_counts_stay_exact(spark):
    big = 3 * 10**12
    df = spark.createDataFrame([(big, big + 17, 10**9)], "n long, total long, v long").select(divergence.share("n", "total").alias("p"))
    assert df.first().p == 1 + 10**9 * (big + 2) // (big + 17 + 2 * 10**9)


def test_empty_clashing_and_long(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [("en", "s%d" % (i % 2), "word again " * (300_000 if i == 3 else 5), 1, "x", "y", 2, 3) for i in range(20)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string, n long, term string, p string, v long, block long")
    assert rows_of(divergence.audit(docs)) == brute([r[:3] for r in rows])


def test_query_equals_sql(spark):
    at = "/root/testdata/sf0.01"
    same(queries.QUERIES["op13_source_divergence"](spark, at), queries.ORACLES["op13_source_divergence"], at)
