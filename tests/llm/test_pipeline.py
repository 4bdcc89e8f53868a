import duckdb
import pandas as pd
import sentencepiece
from test_line_dedup import brute as brute_lines
from test_neardup_similarity import brute as brute_near

import corpus_pipeline as cp
from inspectra.llm import line_dedup, mixing, pieces, quality
from inspectra.llm.common import Workspace

AT = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "text", "lang", "source", "n_chars").collect()))


def test_every_stage_against_brute_force(spark):
    ws = Workspace(spark, "t")
    docs = spark.read.parquet(f"{AT}/documents.parquet")
    kept = {r.doc_id for r in quality.judge(docs, spark.read.parquet(f"{AT}/labels.parquet")).where("kept").collect()}
    a = ws.save(cp.quality_rules(spark, docs, AT), "a")
    assert a.columns == docs.columns
    assert rows(a) == [r for r in rows(docs) if r[0] in kept]

    b = ws.save(cp.lines(spark, a, AT), "b")
    want = {i: t for i, _, _, t in brute_lines(rows(a), line_dedup.MIN_DOCS)}
    assert {r[0]: r[1] for r in rows(b)} == want and b.columns == docs.columns

    c = ws.save(cp.near_duplicates(spark, b, AT), "c")
    want, _ = brute_near(rows(b), cp.SIMILAR)
    assert {r[0] for r in rows(c)} == want and c.columns == docs.columns

    d = ws.save(cp.mix(spark, c, AT), "d")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows(c), columns=["doc_id", "text", "lang", "source", "n_chars"]))
    want = {r[0] for r in con.execute(f"select doc_id from ({mixing.oracle()}) where sampled").fetchall()}
    assert {r[0] for r in rows(d)} == want and d.columns == docs.columns and want

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = {x[0]: x[1] for x in rows(d)}
    assert {r.doc_id: r.token_ids for r in cp.tokens(spark, d, AT).collect()} == {i: library.encode(t) for i, t in texts.items()}


def test_run_and_names(spark):
    out = cp.run(spark, AT)
    assert out.columns == ["doc_id", "source", "lang", "n_tokens", "token_ids"] and out.count() > 0
    assert [n for n, _ in cp.STAGES] == ["quality rules", "line dedup", "MinHash near-dedup", "mixing", "SentencePiece"]


def test_empty(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{AT}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, f"file://{tmp_path}").count() == 0
