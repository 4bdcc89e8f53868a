"""Every query with SQL against DuckDB on the same tables."""

import math

import duckdb
import pytest

from inspectra.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    order = sorted(names)
    rows = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in want.fetchall()), key=repr)
    mine = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=repr)
    assert mine == rows
    assert rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
