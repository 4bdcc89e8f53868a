import hashlib
import random
import re

import pytest
from data import SCHEMA, edge_documents, words

from inspectra.llm import substring_dedup, suffix_dedup

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, words_, w, own):
    """Every window against every earlier one, by dictionary."""
    units = [(r[0], (WORD.findall((r[1] or "").encode()) if words_ else (r[1] or "").encode())) for r in rows]
    least = {}
    for i, u in units:
        if i is not None:
            for s in range(len(u) - w + 1):
                key = tuple(u[s : s + w]) if words_ else u[s : s + w]
                least[key] = min(least.get(key, i), i)
    out = []
    for i, u in units:
        gone, seen = [False] * len(u), set()
        for s in range(len(u) - w + 1) if i is not None else ():
            key = tuple(u[s : s + w]) if words_ else u[s : s + w]
            if least[key] < i or (own and key in seen):
                gone[s : s + w] = [True] * w
            seen.add(key)
        kept = [x for x, g in zip(u, gone, strict=True) if not g]
        kept = b" ".join(kept) if words_ else bytes(kept)
        runs = sum(g and not (n and gone[n - 1]) for n, g in enumerate(gone))
        out.append((i, len(u), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed=4):
    rng = random.Random(seed)
    passages = [words(rng, n) for n in (30, 55, 70, 120, 49, 50, 51)]
    rows = []
    for i in range(70):
        parts = [words(rng, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            parts += [p[a : len(p) - rng.randint(0, len(p) // 3)] if rng.random() < 0.6 else p, words(rng, rng.randint(0, 30))]
        rows.append((1000 - 3 * i, rng.choice(["", " ", "\n"]).join(parts), None, None, None))
    rows += [(2000, "ab" * 400, None, None, None), (2001, "x" * 99 + "y" + "x" * 150, None, None, None), (2002, "a b " * 300, None, None, None), (2003, "ab" * 70, None, None, None)]
    return rows + edge_documents()


def rows_of(df):
    return sorted((tuple(r[:3]) + (len(r.spans), r.kept_sha256) for r in df.collect()), key=repr)


def test_bytes(spark):
    rows = corpus()
    assert rows_of(suffix_dedup.find_repeats(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False, 100, True)


def test_words(spark):
    rows = corpus()
    got = rows_of(substring_dedup.find_repeats(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows, True, 50, False)


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_regular_texts(spark):
    """Texts that hashes of polynomials modulo a power of two take for equal,
    thresholds of one and of several rounds, very long texts."""
    x, y = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    base = " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"{base} {x}", None, None, None), (2, f"{base} {y}", None, None, None), (3, x + y, None, None, None), (4, y + x, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(substring_dedup.find_repeats(df)) == brute(rows, True, 50, False)
    assert rows_of(suffix_dedup.find_repeats(df)) == brute(rows, False, 100, True)
    assert rows_of(suffix_dedup.find_repeats(df, threshold=300)) == brute(rows, False, 300, True)


def test_very_long_text(spark):
    """A text beyond a block's size, holding a passage of another document and
    one of its own; the rest is random."""
    rng = random.Random(8)
    long = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=3_000_000))
    passage = words(rng, 90)
    rows = [(1, passage, None, None, None), (2, long + passage + long[1000:1400], None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in suffix_dedup.find_repeats(df).collect()}
    assert got[1].n_removed == 0 and got[2].n_bytes == len(rows[1][1])
    assert got[2].n_removed == len(passage) + 400
    got = {r.doc_id: r for r in substring_dedup.find_repeats(df).collect()}
    assert got[1].n_removed == 0 and 88 <= got[2].n_removed <= 90


@pytest.mark.parametrize("seed", [1, 2])
def test_small_thresholds(spark, seed):
    """Short thresholds over a tiny alphabet: dense, periodic repeats."""
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choices("ab", k=rng.randint(0, 120))) + "c" * rng.randint(0, 9), None, None, None) for i in range(25)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(suffix_dedup.find_repeats(df, threshold=7)) == brute(rows, False, 7, True)
    rows = [(r[0], " ".join(r[1]), None, None, None) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(substring_dedup.find_repeats(df, window=7)) == brute(rows, True, 7, False)


def test_empty_and_removal(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.find_repeats(empty).count() == 0
    assert substring_dedup.find_repeats(empty).count() == 0
    rows = corpus()
    out = suffix_dedup.remove(spark.createDataFrame([r for r in rows if r[0] != 6], SCHEMA))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert substring_dedup.remove(spark.createDataFrame(rows, SCHEMA)).count() == len(rows)
    want = {i: (n, g) for i, n, g, _, _ in brute([r for r in rows if r[0] != 6], False, 100, True)}
    for r in out.collect():
        n, gone = want[r.doc_id]
        assert len((r.text or "").encode()) <= n - gone


def test_clashing_names(spark):
    """Columns called like the operators' own, and rows that repeat an id."""
    a = words(random.Random(1), 120)
    rows = [(1, a, "x", "y", "z", 1), (2, a + " end of it", "x", "y", "z", 2), (2, "other", "x", "y", "z", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, _spans string, _th string, id int")
    for out in (suffix_dedup.remove(df), substring_dedup.remove(df)):
        assert out.columns == df.columns
        got = {r.id: r.text.strip() for r in out.collect()}
        assert got[1] == a and got[3] == "other" and got[2].endswith("end of it") and len(got[2]) < 120
