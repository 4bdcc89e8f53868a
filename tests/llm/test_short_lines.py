"""Recurring lines of one to four words are boilerplate as longer ones are."""

from data import SCHEMA

from inspectra.llm import line_dedup as ld

MIN = 4
SHORT = ["Les.", "Read more", "All rights reserved.", "Share this on Facebook", "page 7 of this book"]


def test_short_recurring_lines_are_dropped(spark):
    rows = [(i, "\n".join([f"own{'abcdef'[i]} words", *SHORT, "12", "3 4", "", "day 5"]), None, None, 1) for i in range(MIN + 2)]
    rows += [(20, "Les.\nown text\nrare line", None, None, 1), (21, "rare line", None, None, 1)]
    out = {r.doc_id: r.text for r in ld.drop_lines(spark.createDataFrame(rows, SCHEMA), min_docs=MIN).collect()}
    assert out[0] == rows[0][1]
    # Numbers alone, and lines that are half a number, keep too little of themselves.
    assert all(out[i] == f"own{'abcdef'[i]} words\n12\n3 4\n\nday 5" for i in range(1, MIN + 2))
    assert out[20] == "own text\nrare line" and out[21] == "rare line"


def test_lines_below_min_docs_stay(spark):
    rows = [(i, f"Les.\nown{'abcdef'[i]}", None, None, 1) for i in range(MIN - 1)]
    out = ld.drop_lines(spark.createDataFrame(rows, SCHEMA), min_docs=MIN).collect()
    assert {r.doc_id: r.text for r in out} == {r[0]: r[1] for r in rows}
