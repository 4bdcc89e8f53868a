import hashlib
import random
import re
from collections import Counter, defaultdict

from data import SCHEMA, edge_documents, words

from inspectra.llm import line_dedup as ld

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN = 4


def brute(rows, least=MIN):
    """The tree in plain Python: leaves, usual tokens, templates, verdicts."""
    docs = defaultdict(set)  # masked line -> ids
    parsed = []
    for i, t, *_ in rows:
        lines = []
        for line in (t or "").split("\n"):
            tok = tuple("<*>" if re.search("[0-9]", x) else x for x in WORD.findall(line))
            tok = tok if len(tok) >= 1 else None
            lines.append((line, tok))
            if tok and i is not None:
                docs[tok].add(i)
        parsed.append((i, t, lines))
    leaf = lambda tok: (len(tok), tok[: ld.DEPTH])
    in_leaf, placed = defaultdict(set), Counter()
    for tok, ids in docs.items():
        in_leaf[leaf(tok)] |= ids
        for p, x in enumerate(tok):
            placed[leaf(tok), p, x] += len(ids)
    shape, held = {}, defaultdict(set)
    for tok, ids in docs.items():
        if len(in_leaf[leaf(tok)]) < least:
            continue
        t = tuple(x if x != "<*>" and placed[leaf(tok), p, x] >= least else None for p, x in enumerate(tok))
        if sum(x is not None for x in t) >= ld.SIMILARITY * len(t):
            shape[tok] = (leaf(tok), t)
            held[shape[tok]] |= ids
    out = []
    for i, t, lines in parsed:
        keep = [x for x, tok in lines if not (i is not None and tok in shape and len(held[shape[tok]]) >= least and i > min(held[shape[tok]]))]
        text = None if t is None else "\n".join(keep)
        out.append((i, 0 if t is None else len(lines), len(lines) - len(keep), text))
    return out


def corpus():
    rng = random.Random(6)
    fixed = [words(rng, n) for n in (4, 5, 9, 14)]
    rows = []
    for i in range(60):
        lines = [words(rng, rng.randint(1, 14)) for _ in range(rng.randint(1, 5))]
        for _ in range(rng.randint(0, 3)):
            lines.append(
                rng.choice(
                    [
                        *fixed,
                        f"Posted by {words(rng, 1)} on day {rng.randint(1, 31)} in section {rng.choice('ab')} of this site today",
                        "Copyright %d some holder and all rights reserved" % rng.randint(1990, 2024),
                        "the same three words and %s %s %s" % tuple(words(rng, 1) for _ in range(3)),
                        "",
                        "  ",
                    ]
                )
            )
        rng.shuffle(lines)
        rows.append((500 - 7 * i, "\n".join(lines), "en", "s", 7))
    return rows + edge_documents()


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert sum(r[2] for r in want) > 30
    key = lambda x: sorted(x, key=repr)
    got = [tuple(r) for r in ld.report(df, min_docs=MIN).collect()]
    assert key(got) == key((i, n, d, hashlib.sha256((t or "").encode()).hexdigest()) for i, n, d, t in want)
    out = ld.drop_lines(df, length_col="n_chars", min_docs=MIN)
    assert out.columns == df.columns
    assert key((r.doc_id, r.text) for r in out.collect()) == key((i, t) for i, _, _, t in want)
    assert all(r.n_chars in (7, len(r.text)) for r in out.where("doc_id > 50").collect())


def test_variable_fields_are_generalised(spark):
    rows = [(i, f"own line {i}\nPosted by user{i} on day {i} in section a", None, None, 1) for i in range(MIN)]
    rows += [(9, "Posted by someone else entirely at home quietly", None, None, 1)]
    out = {r.doc_id: r.text for r in ld.drop_lines(spark.createDataFrame(rows, SCHEMA), min_docs=MIN).collect()}
    assert out[0].count("\n") == 1 and out[1] == "own line 1" and out[9] == rows[-1][1]


def test_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ld.report(df).count() == 0
    df = spark.createDataFrame(corpus(), SCHEMA).selectExpr("*", "'x' as leaves", "'y' as names", "1 as id")
    assert ld.drop_lines(df, min_docs=MIN).columns == df.columns


def test_clashing_names_and_long_text(spark):
    rows = [(i, f"the same old line of text here\nown words {'abcdefghijklm'[i]}" + (" word" * 400_000 if i == 3 else ""), "x", "y", i) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string, _names string, _n_lines long")
    out = {r.doc_id: r for r in ld.drop_lines(docs).collect()}
    assert all(r._n_lines == i and r._id == "x" for i, r in out.items())
    assert out[0].text == rows[0][1] and all(out[i].text == rows[i][1].split("\n", 1)[1] for i in range(1, 12))
