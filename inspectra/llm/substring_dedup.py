"""Substring dedup: every word covered by a window of 50 words that also starts
in a document of smaller id is removed.

Fixed-block anchors (:mod:`.repeats`): the non-overlapping blocks of 25 words of
every document are the index, every rolling window of 25 words of every document
probes it, and a hit in a later document is extended both ways: first as the
whole stretch of windows that hold the block, named by its text, then, where
stretches differ, window by window.  Any window of 50 words that an earlier
document holds has one of that document's blocks inside, so the hits find every
repeat, and what they extend to is maximal.

Edge cases: null and empty texts have no words; null ids match nothing; rows
that repeat an id do not match each other; texts of fewer words than the window
match nothing; an empty table gives an empty result; very long texts are one
block of their own, handled in memory linear in their length; ids are cast to
long (text that is no number counts as a null id); other columns may have any
names.  Words stay as they are; white space between them is not part of a match.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, fresh
from .repeats import Kind, cut, find

WINDOW = 50


def _kind(window: int) -> Kind:
    return Kind("word", window, 0, False, window // 2)


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed``, ``spans`` (first word ``s``,
    words ``n``), ``kept_sha256`` of the remaining words, single spaces between."""
    found = find(docs, _kind(window), id_col, text_col, Workspace(docs.sparkSession, "substring"))
    return found.select(
        F.col("id").alias(id_col), F.col("units").alias("n_words"), F.col("removed").alias("n_removed"), "spans", F.col("kept_sha").alias("kept_sha256")
    )


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeats cut; texts that lose words have single spaces
    between the remaining ones, other texts stay as they are."""
    kind, at, names = _kind(window), docs.columns.index(text_col), docs.columns
    key, mark, spans = fresh(names, "_id", "_th", "_spans")
    found = find(docs, kind, id_col, text_col, Workspace(docs.sparkSession, "substring")).where("removed > 0")
    found = found.select(F.col("id").alias(key), F.col("th").alias(mark), F.col("spans").alias(spans)).dropDuplicates([key, mark])
    same = (F.col(id_col).try_cast("long") == F.col(key)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(mark))
    joined = docs.join(found.hint("merge"), same, "left").drop(key, mark)

    def apply(batches):
        for b in batches:
            spans_of = b.column(b.num_columns - 1).to_pylist()
            kept = cut(b.column(at), spans_of, kind)
            texts = [v.as_py() if not s or not v.is_valid else k.decode() for v, k, s in zip(b.column(at), kept, spans_of, strict=True)]
            cols = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(apply, docs.schema)
