"""Near-duplicates at the pipeline's similarity, between 0.80 and op8's 0.85."""

import random

import numpy as np
import pytest
from data import SCHEMA, words
from test_neardup_text import near_copies, shingle_set

import corpus_pipeline as cp
from inspectra.llm import neardup_text as nt


def brute(rows, percent):
    sets = [(r[0], shingle_set(r[1])) for r in rows]
    least = {i: i for i, _ in sets}
    links = [(i, j) for n, (i, a) in enumerate(sets) for j, b in sets[n + 1 :] if a and b and 100 * len(a & b) >= percent * len(a | b)]
    for _ in rows:
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    return {i for i in least if least[i] == i}, links


def corpus():
    rng = random.Random(4)
    texts = [words(rng, 60) for _ in range(20)]
    for _ in range(25):
        base = words(rng, rng.randint(150, 260))
        texts += [base, *near_copies(rng, base, 2, (2, 3, 4, 5))]
    rng.shuffle(texts)
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]


def test_pipeline_stage_links_from_080_on(spark):
    rows = corpus()
    want, links = brute(rows, 80)
    assert len(links) > len(brute(rows, 85)[1]) + 10 and want < brute(rows, 85)[0]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id for r in cp.near_duplicates(spark, df, "").collect()} == want
    assert {r.doc_id for r in nt.link(df).where("kept").collect()} == brute(rows, 85)[0]


@pytest.mark.parametrize("how", nt.SCHEMES)
def test_pigeonhole_guarantee_of_every_scheme(how):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 16, (500, how.symbols), dtype=np.uint16)
    y = x.copy()
    for row in y:
        row[rng.choice(how.symbols, how.distance, replace=False)] ^= 1
    assert (nt.chunk_keys(x, how.chunks) == nt.chunk_keys(y, how.chunks)).any(axis=1).all()


def test_unknown_similarity_is_refused():
    with pytest.raises(ValueError):
        nt.scheme(79)
