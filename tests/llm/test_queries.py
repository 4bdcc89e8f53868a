"""The registered queries over whole tables against brute force."""

import hashlib

import sentencepiece
from test_line_dedup import brute as brute_lines
from test_neardup_text import brute as brute_near
from test_neardup_vectors import brute as brute_vectors
from test_quality import brute as brute_quality
from test_repeats import brute as brute_repeats
from test_secrets import brute as brute_secrets

from inspectra.llm import line_dedup, pieces, queries, secrets

AT = "/root/testdata/sf0.001"


def documents(spark):
    return sorted(tuple(r) for r in spark.read.parquet(f"{AT}/documents.parquet").select("doc_id", "text").collect())


def run(spark, name, *columns):
    return sorted(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, AT).collect())


def test_vectors(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{AT}/embeddings.parquet").collect()]
    assert run(spark, "op2_embedding_neardup", "vec_id", "n_links", "component_id", "kept") == sorted(brute_vectors(rows))


def test_pieces(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = run(spark, "op3_sentencepiece", "doc_id", "n_tokens", "round_trip")
    assert got == [(i, len(library.encode(t)), True) for i, t in documents(spark)]


def test_lines(spark):
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute_lines(documents(spark), line_dedup.MIN_DOCS)]
    assert run(spark, "op4_line_dedup", "doc_id", "n_lines", "n_dropped", "kept_sha256") == want


def test_repeats(spark):
    rows = documents(spark)
    want = sorted(brute_repeats(rows, False, 100, True))
    assert run(spark, "op5_suffix_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    want = sorted((i, n, gone, sha) for i, n, gone, _, sha in brute_repeats(rows, True, 50, False))
    assert run(spark, "op6_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_quality(spark):
    got = run(spark, "op7_quality_rules", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == [(i, *brute_quality(t)) for i, t in documents(spark)]


def test_near_duplicates(spark):
    assert run(spark, "op8_minhash_neardup", "doc_id", "n_shingles", "component_id", "kept") == sorted(brute_near(documents(spark)))


def test_secrets(spark):
    out = {r.doc_id: r for r in queries.QUERIES["op10_secret_scan"](spark, AT).collect()}
    for i, t in documents(spark):
        spans = brute_secrets(t)
        text = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        assert out[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [out[i][f"n_{k}"] for k in secrets.KINDS] == [sum(x[1] == n for x in spans) for n in range(3)]
        assert set(text.split(",")) <= set(out[i].spans.split(","))
