"""Comparison of a query with its SQL on the same tables."""

import duckdb


def tables(con, sf_dir):
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations", "events"):
        con.execute(f"create or replace view {t} as select * from '{sf_dir}/{t}.parquet'")


def rows(pairs):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in pairs), key=repr)


def same(spark_df, sql, sf_dir):
    con = duckdb.connect()
    tables(con, sf_dir)
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    order = sorted(names)
    assert sorted(spark_df.columns) == order
    want = [tuple(r[names.index(c)] for c in order) for r in want.fetchall()]
    got = [tuple(r[c] for c in order) for r in spark_df.collect()]
    assert rows(got) == rows(want)
