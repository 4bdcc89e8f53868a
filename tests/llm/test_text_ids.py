"""Ids that are text, with ANSI casts on: numbers in text are ids, anything else
counts as a null id. Nothing crashes and no row is lost."""

import pytest

from inspectra.llm import line_dedup, neardup_text, neardup_vectors, substring_dedup, suffix_dedup

LONG = " ".join("w%d" % (i * 37 % 101) for i in range(120))
ROWS = [("7", LONG, "en"), ("8", LONG, "en"), ("x-9", LONG, "en"), (None, LONG, "en"), ("", "short text", "en"), ("10", None, "en")]


@pytest.fixture
def docs(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    return spark.createDataFrame(ROWS, "doc_id string, text string, lang string")


def test_near_duplicates(docs):
    out = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup_text.link(docs).collect()), key=repr)
    assert len(out) == len(ROWS) and (8, 7, False) in out and (7, 7, True) in out
    assert sum(r[0] is None and r[2] for r in out) == 3


def test_lines(docs):
    assert sorted(map(repr, line_dedup.drop_lines(docs, min_docs=2).select("doc_id").toPandas()["doc_id"])) == sorted(repr(r[0]) for r in ROWS)


def test_repeats(docs):
    for find in (suffix_dedup.find_repeats, substring_dedup.find_repeats):
        rows = find(docs).collect()
        assert len(rows) == len(ROWS)
        assert sum(r.n_removed > 0 for r in rows) == 1
    for remove in (suffix_dedup.remove, substring_dedup.remove):
        kept = {r.doc_id: r.text for r in remove(docs).collect()}
        assert kept["7"] == kept["x-9"] == LONG and kept["8"] == ""


def test_vectors(spark):
    rows = [("1", [1.0, 0.0], "3"), ("2", [1.0, 0.0], "3"), ("a", [1.0, 0.0], "3"), ("4", [1.0, 0.0], "cat")]
    out = sorted(((r.vec_id, r.n_links, r.component_id) for r in neardup_vectors.link(spark.createDataFrame(rows, "vec_id string, embedding array<double>, label string")).collect()), key=repr)
    assert sorted(map(repr, out)) == sorted(map(repr, [(1, 1, 1), (2, 1, 1), (4, 0, 4), (None, 0, None)]))
