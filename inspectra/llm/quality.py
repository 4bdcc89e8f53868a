"""Quality rules: rule statistics per document, judged by an isolation forest.

Base rules (always rejected): fewer than 50 words, or more than half of the
words inside 3-word windows that occur twice or more in the document.  The rest
is judged by path lengths over random splits; the forest is fitted on
well-labelled rows, the threshold is calibrated by cross-fitting on both labels.

Words and lines of one document are compared by 64-bit keyed hashes (see
:mod:`.textscan`), within that document only.

Edge cases: null and empty texts have no words and fail the base rules; very
long texts are a block of their own, in memory linear in their length; rows with
a null id are judged like any other; repeated rows are judged alike; an empty
table gives an empty result; without labelled rows only the base rules decide.
Only the named columns are read, others may have any names, and
:func:`filter_documents` returns the input's columns unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import Block, Words, blocks, gram_hashes, inside_documents, mix, span_hashes

#: Labelled rows used for fitting and calibration, the ones with the least
#: hash of their id: the only sample in this operator.
FIT_ROWS = 4096
TREES, SUBSAMPLE, SEED = 128, 256, 7
#: Parts for cross-fitting: a row is scored by a forest that has not seen it.
FOLDS = 5
#: The cut lies halfway between these quantiles of the well and badly labelled
#: rows' scores; where they overlap, the first alone decides.
KEEP_GOOD, CATCH_BAD = 0.99, 0.05
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_EXTRA = ("n_upper", "n_marks", "n_digits", "n_distinct", "n_lines", "n_short")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?;:@^~_=+{}[]\\/\"")] = True
_HEAD = np.ones(256, bool)  # bytes that begin a code point
_HEAD[0x80:0xC0] = False


def _per_document(flags: np.ndarray, border: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[border[1:]] - total[border[:-1]]


def _twice(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: whether an equal one stands before it, and whether any
    equal one stands elsewhere."""
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    if len(key):
        s = key[order]
        same[1:] = s[1:] == s[:-1]
    later = np.zeros(len(key), bool)
    later[order] = same
    either = same.copy()
    either[:-1] |= same[1:]
    any_ = np.zeros(len(key), bool)
    any_[order] = either
    return later, any_


def _salted(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys that only collide within one document."""
    return mix(key ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def block_statistics(block: Block) -> dict[str, np.ndarray]:
    """Rule statistics of a block's documents, one entry per document."""
    buf, off = block.buf, block.off
    words = Words(block)
    n_docs = len(block.rows)
    out = {"n_words": words.counts()}
    inside = np.zeros(len(buf) + 1, np.int32)
    np.add.at(inside, words.start, 1)
    np.add.at(inside, words.end, -1)
    in_word = np.cumsum(inside[:-1]) > 0
    out["word_chars"] = _per_document(in_word & _HEAD[buf], off)
    for name, flags in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_marks", _MARK), ("n_digits", _DIGIT)):
        out[name] = _per_document(flags[buf], off)

    # Lines: borders at every line feed and at both ends of a document.
    feed = np.flatnonzero(buf == 10)
    start = np.union1d(feed + 1, off[:-1][np.diff(off) > 0])
    start = start[start < len(buf)]
    doc = np.searchsorted(off, start, side="right") - 1
    end = np.minimum(np.append(feed, len(buf))[np.searchsorted(feed, start)], off[doc + 1])
    wordy = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(in_word, out=wordy[1:])
    has = wordy[end] > wordy[start]
    start, end, doc = start[has], end[has], doc[has]
    later, _ = _twice(_salted(span_hashes(buf, start, end), doc))
    out["n_dup_lines"] = np.bincount(doc[later], minlength=n_docs)
    out["n_lines"] = np.bincount(doc, minlength=n_docs)

    h = words.hashes()
    word_doc = np.repeat(np.arange(n_docs), words.counts())
    later, _ = _twice(_salted(h, word_doc))
    out["n_distinct"] = np.bincount(word_doc[~later], minlength=n_docs)
    out["n_short"] = np.bincount(word_doc[(words.end - words.start) <= 3], minlength=n_docs)
    g = gram_hashes(h, 3)
    ok = inside_documents(words.first, 3, len(h))
    at = np.flatnonzero(ok)
    _, twice = _twice(_salted(g[at], word_doc[at]))
    cover = np.zeros(len(h) + 3, np.int32)
    cover[at[twice]] += 1
    covered = cover[: len(h)] + np.concatenate([[0], cover[: len(h)]])[: len(h)]
    covered = covered + np.concatenate([[0, 0], cover[: len(h)]])[: len(h)]
    out["n_repeat_words"] = np.bincount(word_doc[covered > 0], minlength=n_docs)
    return {k: v.astype(np.int64) for k, v in out.items()}


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Statistics of a whole Arrow column of texts."""
    parts = [block_statistics(b) for b in blocks(column)]
    return {
        k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in (*COUNTS, *_EXTRA)
    }


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Length-free ratios, so that long and short clean texts look alike."""
    words = np.maximum(s["n_words"], 1)
    chars = np.maximum(s["word_chars"], 1)
    lines = np.maximum(s["n_lines"], 1)
    return np.column_stack(
        [
            s["word_chars"] / words,
            s["n_symbols"] / words,
            s["n_upper"] / chars,
            s["n_marks"] / words,
            s["n_digits"] / chars,
            s["n_dup_lines"] / lines,
            s["n_repeat_words"] / words,
            s["n_distinct"] / np.power(words, 0.85),
            s["n_short"] / words,
        ]
    ).astype(np.float64)


def _c(n: float) -> float:
    """Mean depth of an unsuccessful search in a tree of n points."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


class IsolationForest:
    """Trees as flat arrays: feature, cut, children, and for leaves the depth
    plus the expected rest for the points that ended there."""

    def __init__(self, x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        take = min(subsample, len(x))
        self.norm = max(_c(take), 1e-9)
        limit = int(np.ceil(np.log2(max(take, 2)))) + 2
        # Features of almost no spread in the sample still need cuts outside it.
        spread = np.maximum(x.std(axis=0), 1e-3)
        self.trees = [self._grow(x[rng.choice(len(x), take, replace=False)], rng, limit, spread) for _ in range(trees)]

    @staticmethod
    def _grow(x: np.ndarray, rng, limit: int, spread: np.ndarray):
        feat, cut, left, right, depth = [], [], [], [], []

        def node(rows: np.ndarray, d: int) -> int:
            at = len(feat)
            for a in (feat, cut, left, right, depth):
                a.append(0)
            if d >= limit or len(rows) <= 1:
                depth[at], left[at], right[at] = d + _c(len(rows)), at, at
                return at
            f = int(rng.integers(rows.shape[1]))
            lo, hi = rows[:, f].min() - 3 * spread[f], rows[:, f].max() + 3 * spread[f]
            feat[at], cut[at] = f, float(rng.uniform(lo, hi))
            below = rows[:, f] < cut[at]
            left[at] = node(rows[below], d + 1)
            right[at] = node(rows[~below], d + 1)
            return at

        node(x, 0)
        return (np.array(feat, np.int32), np.array(cut), np.array(left, np.int32), np.array(right, np.int32), np.array(depth, float), limit)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1]; short paths score high."""
        if not len(x):
            return np.zeros(0)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feat, cut, left, right, depth, limit in self.trees:
            at = np.zeros(len(x), np.int32)
            for _ in range(limit):
                below = x[rows, feat[at]] < cut[at]
                at = np.where(below, left[at], right[at])
            total += depth[at]
        return np.exp2(-total / len(self.trees) / self.norm)


class Verdict:
    """Forest and threshold; keeps everything when there was nothing to fit.
    The threshold comes from scores out of sample, so that the rows that grew
    the trees do not move it, and from quantiles, so that no single row does."""

    def __init__(self, x: np.ndarray, quality: np.ndarray, seed: int = SEED):
        good, bad = x[quality == 1], x[quality == 0]
        self.forest, self.threshold = None, 1.0
        if len(good) < 8:
            return
        self.forest = IsolationForest(good)
        fold = np.random.default_rng(seed).permutation(len(good)) % FOLDS
        g, b = np.zeros(len(good)), np.zeros(len(bad))
        for k in range(FOLDS):
            forest = IsolationForest(good[fold != k], seed=seed + 1 + k)
            g[fold == k] = forest.score(good[fold == k])
            b += forest.score(bad) / FOLDS
        high = float(np.quantile(g, KEEP_GOOD))
        low = float(np.quantile(b, CATCH_BAD)) if len(b) else high
        self.threshold = (high + low) / 2 if low > high else high + 1e-9

    def keeps(self, s: dict[str, np.ndarray]) -> np.ndarray:
        ok = ~base_failed(s)
        if self.forest is not None and ok.any():
            at = np.flatnonzero(ok)
            ok[at] = self.forest.score(features({k: v[at] for k, v in s.items()})) <= self.threshold
        return ok


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = FIT_ROWS) -> Verdict:
    """Fit on at most ``max_rows`` labelled rows. Only their ids are broadcast
    and only their statistics reach the driver. Null labels and labels other
    than 0 and 1 are ignored; of several labels for a row the least counts."""
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col("quality").isin(0, 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min("quality").cast("int").alias("_quality"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_rows)
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    names = (*COUNTS, *_EXTRA)

    def measure(batches):
        for b in batches:
            s = statistics(b.column("_text"))
            yield pa.RecordBatch.from_pydict({"_id": b.column("_id"), "_quality": b.column("_quality"), **s})

    kind = docs.schema[id_col].dataType.simpleString()
    got = (
        rows.mapInArrow(measure, f"_id {kind}, _quality int, " + ", ".join(f"{n} long" for n in names))
        .orderBy("_id", *names)
        .limit(2 * max_rows)
        .toPandas()
    )
    s = {n: got[n].to_numpy(np.int64) for n in names}
    ok = ~base_failed(s)
    return Verdict(features(s)[ok], got["_quality"].to_numpy()[ok])


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the five counts, ``base_failed``, ``kept``."""
    verdict = fit(docs, labels, id_col, text_col)

    def measure(batches):
        for b in batches:
            s = statistics(b.column("_text"))
            yield pa.RecordBatch.from_pydict(
                {id_col: b.column("_id"), **{n: s[n] for n in COUNTS}, "base_failed": base_failed(s), "kept": verdict.keeps(s)}
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        measure, f"{id_col} {kind}, " + ", ".join(f"{n} long" for n in COUNTS) + ", base_failed boolean, kept boolean"
    )


def filter_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that pass, all columns kept; one pass, no shuffle."""
    verdict = fit(docs, labels, id_col, text_col)
    at = docs.columns.index(text_col)

    def keep(batches):
        for b in batches:
            yield b.filter(pa.array(verdict.keeps(statistics(b.column(at)))))

    return docs.mapInArrow(keep, docs.schema)
