"""Suffix-array dedup: every byte covered by a 100-byte string that also starts
earlier (smaller id, or earlier in the document) is removed.

Distributed prefix doubling (:mod:`.repeats`).  A row for every byte and round
does not fit a corpus, so one sampled round comes first: positions are ranked by
``GRAM`` bytes where a window of 100 bytes takes its sample, and positions under
a sample that stands nowhere else are unique and dropped; stretches that agree
as a whole with an earlier one are settled as runs.  The positions that are
left, in the same document or in others, go through the rounds: pairs of the rank
at a position and at an offset from it, sorted by Spark, ranked anew, unique
ranks dropped, offsets growing until the threshold.  Prefixes of 64 bytes are
named in the task that reads them, so 100 bytes take one round (offset 36), 300
bytes three (64, 128, 44).

Edge cases: null and empty texts have no bytes; null ids match nothing; rows
that repeat an id do not match each other; texts shorter than the threshold
match nothing; an empty table gives an empty result; very long texts are one
block of their own, handled in memory linear in their length; ids are cast to
long (text that is no number counts as a null id); other columns may have any
names.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, fresh
from .repeats import Kind, cut, find

THRESHOLD = 100
#: Length of the samples' grams, as a share of the threshold.
GRAM = 0.64


def _kind(threshold: int) -> Kind:
    return Kind("byte", threshold, max(1, int(GRAM * threshold)), True)


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``spans`` (first byte ``s``,
    bytes ``n``), ``kept_sha256`` of the remaining bytes."""
    found = find(docs, _kind(threshold), id_col, text_col, Workspace(docs.sparkSession, "suffix"))
    return found.select(
        F.col("id").alias(id_col), F.col("units").alias("n_bytes"), F.col("removed").alias("n_removed"), "spans", F.col("kept_sha").alias("kept_sha256")
    )


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with the repeats cut from the text; all columns stay. A text
    that loses part of a character keeps what is valid UTF-8."""
    kind, at, names = _kind(threshold), docs.columns.index(text_col), docs.columns
    key, mark, spans = fresh(names, "_id", "_th", "_spans")
    found = find(docs, kind, id_col, text_col, Workspace(docs.sparkSession, "suffix")).where("removed > 0")
    found = found.select(F.col("id").alias(key), F.col("th").alias(mark), F.col("spans").alias(spans)).dropDuplicates([key, mark])
    same = (F.col(id_col).try_cast("long") == F.col(key)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(mark))
    joined = docs.join(found.hint("merge"), same, "left").drop(key, mark)

    def apply(batches):
        for b in batches:
            kept = cut(b.column(at), b.column(b.num_columns - 1).to_pylist(), kind)
            texts = [None if not v.is_valid else k.decode("utf-8", "ignore") for v, k in zip(b.column(at), kept, strict=True)]
            cols = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(apply, docs.schema)
