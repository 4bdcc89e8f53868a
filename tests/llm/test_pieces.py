import random
import re
from types import SimpleNamespace

import pyarrow as pa
import pytest
import sentencepiece
from data import SCHEMA, edge_documents, words

from inspectra.llm import pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Vocabulary())


def texts():
    rng = random.Random(8)
    out = [r[1] for r in edge_documents()]
    out += ["", " ", "  ", "a  b   c    ", "\n\n\t x\r\n", "▁x ▁▁ y", "naïve ÑANDÚ 日本語 текст 🙂🙂 ​", "<s> </s> <0x0A> <unk>", "x" * 300, " lead", "trail "]
    out += ["".join(rng.choice("abcdefghij XYZ.,'1239\n") for _ in range(rng.randint(1, 200))) for _ in range(200)]
    out += ["".join(chr(rng.choice([rng.randint(33, 126), rng.randint(0xA1, 0x5FF), rng.randint(0x3040, 0x30FF), rng.randint(0x4E00, 0x4FFF)])) for _ in range(60)) for _ in range(100)]
    out += [words(rng, 300) for _ in range(20)]
    out.append("The quick brown fox jumps over the lazy dog; internationalization of antidisestablishmentarianism, don't you think? " * 3)
    return out


def test_ids_equal_the_library(encoder, library):
    for t, got in zip(texts(), encoder.encode(texts()), strict=True):
        assert got.tolist() == library.encode(t or ""), repr(t)[:200]


def test_real_documents(encoder, library, spark, sf_dir):
    rows = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for t, got in zip(rows, encoder.encode(rows), strict=True):
        assert got.tolist() == library.encode(t)
        assert pieces.decode(encoder.v, got.tolist()) == t


def test_documents_round_trip(spark):
    rows = edge_documents()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as token_ids")
    enc = pieces.encode(df, check=True)
    assert [c for c in enc.columns] == ["doc_id", "lang", "source", "n_chars", "token_ids", "round_trip"]
    assert all(r.round_trip for r in enc.collect())
    back = pieces.decode_documents(enc.drop("round_trip")).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == sorted(((r[0], r[1]) for r in rows), key=repr)
    assert pieces.encode(spark.createDataFrame([], SCHEMA)).count() == 0


def test_units_are_cut_as_the_rule_says():
    cut = re.compile(f"{pieces.MARK}+[^{pieces.MARK}\n]*|\n|[^{pieces.MARK}\n]+")
    every = [None, *texts(), "", None, "\n", " \n \n\n  x", "▁", "a\n▁▁b ▁\n", None]
    for rows in (every, every[3:9], [], [None], ["", ""]):
        # A slice, as the texts of a batch come in slices.
        units, border = pieces.split_units(pa.array(["before it", *rows, "after it"], pa.string()).slice(1, len(rows)))
        units = [u.replace(" ", pieces.MARK) for u in units.to_pylist()]
        want = [cut.findall(pieces.MARK + t.replace(" ", pieces.MARK)) if t else [] for t in rows]
        assert [units[a:b] for a, b in zip(border[:-1], border[1:], strict=True)] == want


def test_edges_are_all_occurrences_of_pieces():
    rng = random.Random(5)
    tokens = list(dict.fromkeys("".join(rng.choice("ab▁") for _ in range(n)) for n in [1, 2, 3, 4, 5, 7, 8, 9, 12, 16, 17, 20, 33] * 30))
    text = "".join(rng.choice("ab c\0") for _ in range(3000)) + "".join(rng.sample(tokens, 200)).replace(pieces.MARK, " ") + "\0"
    encoder = pieces.Encoder(SimpleNamespace(reached=tokens, ids={t: i for i, t in enumerate(tokens)}))
    assert len(encoder.classes) == 5
    codes = encoder._codes(text)
    codes[[i for i, c in enumerate(text) if c == "\0"]] = 0
    start, token = encoder._edges(codes)
    want = [(i, k) for k, t in enumerate(tokens) for i in range(len(text)) if text.startswith(t.replace(pieces.MARK, " "), i)]
    assert sorted(zip(start.tolist(), token.tolist(), strict=True)) == sorted(want)


def test_token_pairs_outlive_units():
    """What costs most, merging the text of two tokens, is done once for a pair."""
    asked = []
    encoder = pieces.Encoder(pieces.Vocabulary())
    merge = encoder.v.merge
    encoder.v.merge = lambda text: asked.append(text) or merge(text)
    first = encoder.encode(texts())
    assert asked and len(asked) == len(encoder.pairs)
    asked.clear()
    encoder.forget()
    for a, b in zip(first, encoder.encode(texts()), strict=True):
        assert a.tolist() == b.tolist()
    assert not asked


def test_small_limits_give_the_same(library, monkeypatch):
    for name, value in {"PAIR_BITS": 3, "REMEMBER": 4, "INDEX_CHARS": 40}.items():
        monkeypatch.setattr(pieces, name, value)
    encoder = pieces.Encoder(pieces.Vocabulary())
    for t in texts()[::5]:
        assert encoder.encode([t, None, t])[2].tolist() == library.encode(t or "")
