import duckdb
import numpy as np
from data import SCHEMA, edge_documents
from oracle import same

from inspectra.llm import mixing, queries
from inspectra.llm.common import Workspace


def test_query_equals_sql(spark):
    at = "/root/testdata/sf0.01"
    same(queries.op9_source_mixing(spark, at), queries.ORACLES["op9_source_mixing"], at)


def test_marginals_and_expected_size(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = mixing.sample(docs).toPandas()
    total = out.n_tokens.sum()
    assert abs((out.n_tokens * out.probability).sum() / total - mixing.KEEP) < 0.01
    drawn = out[out.sampled].n_tokens.sum() / total
    assert abs(drawn - mixing.KEEP) < 0.08
    assert not out[out.n_tokens == 0].sampled.any()


def test_raking_meets_given_targets(spark):
    rng = np.random.default_rng(2)
    cells = [(s, g, t, 1, int(rng.integers(10, 1000))) for s in "abc" for g in ("x", "y") for t in ("p", "q")]
    c = spark.createDataFrame(cells, "source string, lang string, topic string, n_docs long, n_tokens long")
    targets = {"source": {"a": 0.2, "b": 0.3, "c": 0.5}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"p": 0.5, "q": 0.5}}
    w = mixing.rake(c, Workspace(spark, "t"), targets, rounds=30).toPandas()
    for axis, shares in targets.items():
        got = w.groupby(axis).weight.sum()
        for k, v in shares.items():
            assert abs(got[k] - v) < 1e-6


def test_edge_documents(spark):
    rows = edge_documents()
    out = mixing.sample(spark.createDataFrame(rows, SCHEMA))
    got = out.collect()
    assert len(got) == len(rows)
    assert all(not r.sampled for r in got if r.n_tokens == 0)
    con = duckdb.connect()
    import pandas as pd

    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64"})
    con.register("documents", documents)
    want = con.execute(mixing.oracle()).fetchall()
    key = lambda r: tuple(None if x is None else round(float(x), 6) if isinstance(x, float) else x for x in r)
    assert sorted(map(repr, map(key, map(tuple, got)))) == sorted(map(repr, map(key, want)))
    assert mixing.sample(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_is_native(spark):
    docs = spark.createDataFrame(edge_documents(), SCHEMA)
    plan = mixing.sample(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_marginals_after_capping(spark):
    """Raked shares meet their targets; categories without a cell at probability
    1 keep their proportions among each other only as far as capping allows, and
    the report says by how much the sample misses."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    ws = Workspace(spark, "t")
    measured = docs.select(*mixing._measures("text", "source", "lang", None))
    fitted = mixing.rake(mixing.cells(measured), ws)
    assert mixing.gap(fitted) <= mixing.TOLERANCE
    p = mixing.probabilities(fitted)
    m = mixing.marginals(p).toPandas()
    assert (m.raked - m.target).abs().max() < 1e-8
    assert set(m[m.axis == "topic"].category) >= {"prose", "contact"}
    for _, part in m.groupby("axis"):
        assert abs(part.target.sum() - 1) < 1e-9 and abs(part.expected.sum() - 1) < 1e-6
    # Where nothing is capped the sample meets the target.
    free = mixing.marginals(mixing.probabilities(fitted, keep=0.01)).toPandas()
    assert not free.capped.any() and (free.expected - free.target).abs().max() < 1e-4


def test_unreachable_targets_are_reported(spark):
    import pytest

    c = spark.createDataFrame([("a", "x", "p", 1, 10), ("b", "y", "p", 1, 10)], "source string, lang string, topic string, n_docs long, n_tokens long")
    targets = {"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}}
    with pytest.raises(ValueError, match="cannot be met"):
        mixing.rake(c, Workspace(spark, "t"), targets, strict=True)
    with pytest.warns(UserWarning, match="cannot be met"):
        mixing.rake(c, Workspace(spark, "t"), targets)


def test_filter_with_clashing_names_and_long_text(spark):
    rows = [(i, "word " * (400_000 if i == 3 else 50), "en", "s", 1, 2, "u") for i in range(20)] + [(50, " ", "en", "s", 1, 2, "u"), (51, None, "en", "s", 1, 2, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row int, m int, u string")
    out = mixing.filter_documents(docs)
    drawn = {r.doc_id for r in mixing.sample(docs).where("sampled").collect()}
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == drawn


def test_missed_targets_are_told_or_met(spark):
    """A sample too large for its targets says which shares it misses and by how
    much; with ``meet`` it is smaller and every share is within one per cent."""
    import pytest

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    with pytest.warns(UserWarning, match="misses its targets.*topic"):
        large = mixing.sample(docs)
    small = mixing.sample(docs, meet=True).toPandas()
    weight = small.n_tokens * small.probability
    share = weight.sum() / small.n_tokens.sum()
    assert 0 < share < mixing.KEEP and small.probability.max() <= 1
    measured = docs.select(*mixing._measures("text", "source", "lang", None))
    fitted = mixing.rake(mixing.cells(measured), Workspace(spark, "t"))
    want = mixing.marginals(mixing.probabilities(fitted)).toPandas()
    assert abs(share - mixing.reachable(fitted)) < 1e-4
    for axis in mixing.AXES:
        got = weight.groupby(small[axis].fillna("")).sum() / weight.sum()
        for r in want[want.axis == axis].itertuples():
            assert abs(got[r.category or ""] - r.target) <= 0.01 * r.target
    assert large.count() == len(small)
    assert mixing.filter_documents(docs, meet=True).count() == small.sampled.sum()


def test_meeting_targets_on_an_empty_table(spark):
    assert mixing.sample(spark.createDataFrame([], SCHEMA), meet=True).count() == 0
