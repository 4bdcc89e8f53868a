import hashlib
import random
import re

from data import SCHEMA, edge_documents
from oracle import same

from inspectra.llm import pii, queries

PLAIN = [re.compile(pii._PLAIN[k.name]) for k in pii.BASE]


def luhn(text):
    d = [int(c) for c in text if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def brute(text):
    """Base spans (start, kind, end) in plain Python."""
    out = []
    for k, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text or ""):
            v, n = m.group(), sum(c.isdigit() for c in m.group())
            ok = (True, k == 1 and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in v.split(".")), 12 <= n <= 19 and luhn(v), 9 <= n <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


TRICKY = [
    "a@b.c_foo@bar.com, x@y.z@w.v a@b a@b.c.@d.e .@- é@ü.de",
    "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 0001.0255.00000255.9 1.2.3.4.5 12.34.56.7890 99999999999999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111111 5 4111111111111111-7 1 2 3 4111--1111",
    "+1 (487) 555-7209 ++49 30 12345 678. +1+2 +12345678901234567 +1 2 3 4 5 6 7 8 9 ) + 1 234567890",
    "ñ" * 30 + " mail: x.y+z@ex-ample.co.uk, 10.0.0.1; phone +34 600 000 000" + "𝒳" * 3 + " 192.168.0.1",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432. konto DE89370400440532013001 XGB82WEST12345698765432 NO9386011117947",
    "call 555-123-4567 today; hotel 555-123-4568 and some twenty more letters; fax: (555) 123-4569 and +1 555-123-4567 phone",
    "ssn 123-45-6789, 123-45-6780 alone far from any word of that sort ............ social 000-12-3456 ssn: 12-123-45-6789",
    "born 1980-02-29, version 1.2.2020 came out some time before, DOB: 03/04/1999 geboren am 4.5.1961",
]


def check(docs, rows):
    """Base spans equal brute force; further ones come on top."""
    got = sorted(((r.doc_id, r.spans) for r in pii.find(docs).collect()), key=repr)
    names = [k.name for k in pii.BASE]
    assert sorted(repr((i, [(s.start, names.index(s.kind), s.end) for s in spans if s.kind in names])) for i, spans in got) == sorted(repr((r[0], brute(r[1]))) for r in rows)
    return {i: spans for i, spans in got}


def test_edge_and_tricky_documents(spark):
    rows = edge_documents() + [(100 + i, t, "en", "s", 1) for i, t in enumerate(TRICKY)]
    found = check(spark.createDataFrame(rows, SCHEMA), rows)
    further = lambda n: [(s.kind, TRICKY[n][s.start : s.end]) for s in found[100 + n] if s.kind not in [k.name for k in pii.BASE]]
    assert further(5) == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432"), ("iban", "NO9386011117947")]
    assert further(6) == [("local_phone", "555-123-4567"), ("local_phone", "(555) 123-4569")]
    assert further(7) == [("social", "123-45-6789")]
    assert further(8) == [("birth_date", "1980-02-29"), ("birth_date", "03/04/1999"), ("birth_date", "4.5.1961")]
    assert pii.find(spark.createDataFrame([], SCHEMA)).count() == 0


def test_random_texts(spark):
    rng = random.Random(4)
    parts = ["@", ".", "-", " ", "+", "1", "42", "255", "300", "0", "a", "b_", "Z%", "(", ")", "4111111111111111", "é", "\n", "4111 1111", "1111-1111", ".com"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 120))), "en", "s", 1) for i in range(1500)]
    check(spark.createDataFrame(rows, SCHEMA), rows)


def test_context_moves_the_score(spark):
    texts = ["card 4111111111111111", "number 4111111111111111"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    scores = {r.doc_id: r.spans[0].score for r in pii.find(docs).collect()}
    assert scores[0] == scores[1] + 20


def test_held_out_formats(spark):
    """Planted account numbers are found, wrong checksums and plain numbers are not."""
    rng = random.Random(8)

    def iban(country, wrong=False):
        body = "".join(rng.choice("0123456789") for _ in range(pii.IBAN_LENGTHS[country] - 4))
        left = int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        return f"{country}{(98 - left + wrong) % 100:02d}{body}"

    rows = []
    for i in range(600):
        token = iban(rng.choice(sorted(pii.IBAN_LENGTHS)), wrong=i % 3 == 1) if i % 3 < 2 else "".join(rng.choice("0123456789ABCDEF") for _ in range(24))
        rows.append((i, f"Some words {token} and more.", "en", "s", 1))
    hits = {r.doc_id for r in pii.find(spark.createDataFrame(rows, SCHEMA)).collect() if any(s.kind == "iban" for s in r.spans)}
    assert hits == {i for i in range(600) if i % 3 == 0}


def test_long_texts_and_many_matches(spark):
    """Megabytes of one run neither overflow the stack nor take square time, and
    hundreds of thousands of matches keep exact offsets."""
    rows = [
        (0, "a" * 3_000_000), (1, "1" * 1_000_000), (2, "1 " * 700_000), (3, "a@" + "b." * 400_000 + "c"), (4, "+1" + " " * 2_000_000 + "23456789"),
        (5, "x@y.zz " * 60_000), (6, "1.2.3.4 " * 30_000), (7, "1." * 400_000), (8, "+" * 500_000 + "49 30 1234567"), (9, "0" * 900_000 + "1.1.1.1"),
    ]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i] for i in (0, 1, 2)] == [[], [], []]
    assert found[3] == [("email", 0, 800_003)] and found[4] == [("phone", 0, 2_000_010)]
    assert found[5] == [("email", 7 * i, 7 * i + 6) for i in range(60_000)]
    assert found[6] == [("ip", 8 * i, 8 * i + 7) for i in range(30_000)]
    assert found[7] == [("ip", 8 * i, 8 * i + 7) for i in range(100_000)]
    assert found[8] == [("phone", 499_999, 500_013)] and found[9] == [("ip", 0, 900_007)]


def test_plan_is_native_and_needs_no_shuffle(spark):
    plan = pii.find(spark.createDataFrame(edge_documents(), SCHEMA))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


def test_clashing_names(spark):
    rows = [(1, "x@y.zz", "t", "m", "s"), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, t string, m0 string, spans string")
    assert sorted((r.doc_id or "", len(r.spans)) for r in pii.find(docs.withColumn("doc_id", docs.doc_id)).collect()) == [("", 0), ("1", 1)]


def test_query_equals_brute_force_and_sql(spark):
    at = "/root/testdata/sf0.01"
    out = queries.QUERIES["op11_pii"](spark, at)
    names = [k.name for k in pii.BASE]
    texts = dict(tuple(r) for r in spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").collect())
    for r in out.collect():
        spans = brute(texts[r.doc_id])
        assert [r[f"n_{k}"] for k in names] == [sum(x[1] == n for x in spans) for n in range(4)]
        text = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
    same(out, queries.ORACLES["op11_pii"], at)


def test_sql_on_tricky_texts(spark, tmp_path):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(TRICKY + [None, "", "IBAN " + TRICKY[5]])]
    (tmp_path / "t").mkdir()
    spark.createDataFrame(rows, SCHEMA).coalesce(1).toPandas().to_parquet(tmp_path / "t" / "documents.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/t/documents.parquet'")
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    want = sorted(con.execute(f"select {', '.join(names)} from ({queries.ORACLES['op11_pii']})").fetchall())
    got = queries.pii_columns(pii.find(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == want
