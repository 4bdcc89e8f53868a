import base64
import hashlib

import pytest

from inspectra.llm import queries, warc

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (5, "http://a/\r\nX: 1", "same"),
    (3, "http://b", "same"),
    (9, None, "same"),
    (4, "http://c", None),
    (7, "http://d", ""),
    (8, "http://e", "é" * 70000),
    (8, "http://f", "é" * 70000),
    (10, "http://g", "only"),
    (None, "http://h", "lonely"),
    (None, "http://i", "same"),
]


def b32(x):
    return base64.b32encode(hashlib.sha1(x).digest()).decode()


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    seen, out = set(), []
    for i, u, h in rows:
        p = (h or "").encode()
        revisit = i is not None and (first[h or ""] != i or (i, h) in seen)
        seen.add((i, h))
        out.append((i, len(p), b32(p), "revisit" if revisit else "response", first[h or ""] if revisit else None))
    return sorted(out, key=repr)


@pytest.fixture()
def archive(spark, tmp_path):
    path = f"file://{tmp_path}/archive"
    warc.write_archive(spark.createDataFrame(ROWS, SCHEMA), path)
    return path


def test_records(spark, archive):
    got = sorted((tuple(r)[:5] for r in warc.read_records(spark, archive).collect()), key=repr)
    assert got == expected(ROWS)


def test_payloads_stored_once(spark, archive):
    assert spark.read.parquet(f"{archive}/payloads").count() == 5


def test_records_round_trip(spark, archive):
    rows = warc.reconstruct(spark, archive).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        fields, content = warc.parse_record(bytes(r.record))
        assert fields["WARC-Payload-Digest"] == "sha1:" + b32(bytes(r.payload))
        assert content == (b"" if fields["WARC-Type"] == "revisit" else bytes(r.payload))
        if fields["WARC-Type"] == "revisit":
            assert fields["WARC-Refers-To"].startswith("<urn:uuid:")


def test_small_payloads_are_responses(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    warc.write_archive(spark.createDataFrame(ROWS, SCHEMA), path, min_revisit=5)
    kinds = {(r.id, r.record_type) for r in warc.read_records(spark, path).collect()}
    assert (5, "response") in kinds and (9, "response") in kinds and (8, "revisit") in kinds


def test_damaged_payload_is_noticed(spark, archive):
    bad = spark.read.parquet(f"{archive}/payloads").selectExpr("digest", "concat(payload, X'00') as payload").collect()
    spark.createDataFrame(bad, "digest binary, payload binary").write.mode("overwrite").parquet(f"{archive}/payloads")
    with pytest.raises(Exception, match="does not match"):
        warc.read_records(spark, archive).collect()


def test_empty_table_and_query(spark, tmp_path, sf_dir):
    path = f"file://{tmp_path}/e"
    warc.write_archive(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_records(spark, path).count() == 0
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = expected([(r.page_id, r.url, r.html) for r in pages.collect()])
    assert sorted((tuple(r)[:5] for r in queries.op1_warc_archive(spark, sf_dir).collect()), key=repr) == want


def test_record_ids_are_unique_and_headers_count(spark, archive):
    """Rows that repeat an id have records of their own; what the reader returns
    comes from the header's bytes, so a wrong header is noticed."""
    heads = spark.read.parquet(f"{archive}/headers").collect()
    ids = [bytes(r.header).split(b"WARC-Record-ID: ")[1].split(b"\r\n")[0] for r in heads]
    assert len(set(ids)) == len(ROWS)
    wrong = [(r.id, bytes(r.header).replace(b"WARC-Type: revisit", b"WARC-Type: metadata"), bytes(r.digest), r.record_type) for r in heads]
    spark.createDataFrame(wrong, spark.read.parquet(f"{archive}/headers").schema).write.mode("overwrite").parquet(f"{archive}/headers")
    with pytest.raises(Exception, match="does not match"):
        warc.read_records(spark, archive).collect()


def test_lost_payload_is_noticed(spark, archive):
    left = spark.read.parquet(f"{archive}/payloads").collect()[1:]
    spark.createDataFrame(left, "digest binary, payload binary").write.mode("overwrite").parquet(f"{archive}/payloads")
    with pytest.raises(Exception, match="no payload"):
        warc.read_records(spark, archive).collect()


def test_long_payload_and_clashing_names(spark, tmp_path):
    path = f"file://{tmp_path}/long"
    rows = [(1, "u", "z" * 20_000_000, 1, "a"), (2, None, "z" * 20_000_000, 2, "b")]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string, id int, digest string"), path)
    got = sorted(tuple(r)[:5] for r in warc.read_records(spark, path).collect())
    assert got == [(1, 20_000_000, b32(b"z" * 20_000_000), "response", None), (2, 20_000_000, b32(b"z" * 20_000_000), "revisit", 1)]
