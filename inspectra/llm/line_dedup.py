"""Line dedup with a log-template tree.

Lines are parsed to a fixed depth: a leaf is a number of tokens and the
``DEPTH`` leading tokens.  Tokens with a digit are variable from the start;
within a leaf, a token that fewer than ``min_docs`` documents have in its place
is variable too.  What remains is the line's template; it must keep at least
``SIMILARITY`` of the tokens.  A template that ``min_docs`` documents hold is
boilerplate: its lines are dropped from all of them but the one of least id.

Only leaves that enough documents share go on, so the tokens of ordinary prose
never leave the task that reads them.  Counts are pre-aggregated before every
shuffle; a leaf, line or template that a third of all documents holds is one
row for each document, spread by document.

Lines and leaves are compared by 64-bit keyed hashes (see :mod:`.textscan`).

Edge cases: lines of variable tokens only are never dropped, as no template can
keep enough of them; lines of ``DEPTH`` tokens or fewer are their own leaf; null
and empty texts stay as they are; very long texts are a block of their own, in
memory linear in their length; a null id keeps all its lines and counts for no
template; rows that repeat an id are one document; a text that loses all its
lines becomes empty and its row stays; an empty table gives an empty result; ids
are cast to long (text that is no number counts as a null id); other columns may
have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, free_shuffles, fresh
from .repeats import _distinct, _lists, _member, _per_document
from .textscan import Block, Words, blocks, joined, sequence_hashes

DEPTH, SIMILARITY = 3, 0.75
#: Documents that hold a template before it counts as boilerplate.
MIN_DOCS = 10
_VARIABLE = np.uint64(0x2545F4914F6CDD1D)
_U = np.uint64


class Lines:
    """Lines of a block that hold a word: document, first word, number of
    words, leaf, hash of the tokens, and their tokens' hashes."""

    def __init__(self, block: Block):
        w = Words(block)
        n = len(w.start)
        feeds = np.zeros(len(block.buf) + 1, np.int64)
        np.cumsum(block.buf == 10, out=feeds[1:])
        digits = np.zeros(len(block.buf) + 1, np.int64)
        np.cumsum((block.buf >= 48) & (block.buf <= 57), out=digits[1:])
        doc = np.repeat(np.arange(len(block.rows)), w.counts())
        at = feeds[w.start]
        new = np.ones(n, bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        self.first = np.flatnonzero(new)
        self.size = np.diff(np.append(self.first, n))
        self.doc = doc[self.first]
        # A line's place among its document's lines, empty ones counted.
        self.line = at[self.first] - feeds[block.off[self.doc]] if n else at
        tokens = w.hashes()
        masked = digits[w.end] > digits[w.start]
        tokens[masked] = _VARIABLE
        self.tokens = tokens
        to = self.first + self.size
        lead = self.first + np.minimum(self.size, DEPTH)
        self.name = sequence_hashes(tokens, self.first, to)
        self.leaf = joined(sequence_hashes(tokens, self.first, lead), self.size.astype(np.uint64))
        plain = np.zeros(n + 1, np.int64)
        np.cumsum(~masked, out=plain[1:])
        self.parsed = plain[to] > plain[self.first]


def _leaves(batches):
    for b in batches:
        parts = []
        for block in blocks(b.column("text")):
            x = Lines(block)
            leaf, doc = _distinct(x.leaf[x.parsed], x.doc[x.parsed])
            parts.append(_lists(leaf, doc, len(block.rows)))
        if parts:
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.concat_arrays(parts)], ["id", "leaves"])


def _hot_lines(batches):
    """Distinct lines of a document in the leaves that go on."""
    shape = pa.schema([("id", pa.int64()), ("leaf", pa.int64()), ("name", pa.int64()), ("tokens", pa.list_(pa.int64()))])
    for b in batches:
        hot_doc, hot = _per_document(b.column("leaves"), b.num_rows)
        hot, ids = hot.view(np.uint64), b.column("id").to_numpy()
        for block in blocks(b.column("text")):
            x = Lines(block)
            row = block.rows[x.doc] if len(x.doc) else x.doc
            at = np.flatnonzero(_member(x.leaf, row, hot, hot_doc) & x.parsed)
            if not len(at):
                continue
            order = at[np.lexsort((x.name[at], x.doc[at]))]
            new = np.ones(len(order), bool)
            new[1:] = (x.name[order[1:]] != x.name[order[:-1]]) | (x.doc[order[1:]] != x.doc[order[:-1]])
            at = order[new]
            n = x.size[at]
            flat = x.tokens[np.repeat(x.first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            border = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row[at]]), pa.array(x.leaf[at].view(np.int64)), pa.array(x.name[at].view(np.int64)), pa.ListArray.from_arrays(pa.array(border), pa.array(flat.view(np.int64)))],
                schema=shape,
            )


def boilerplate(docs: DataFrame, id_col: str, text_col: str, ws: Workspace, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(id, names)``: hashes of the lines to drop from each document."""
    texts = docs.where(F.col(id_col).try_cast("long").isNotNull() & (F.length(F.col(text_col)) > 0)).select(F.col(id_col).try_cast("long").alias("id"), F.col(text_col).alias("text"))
    scan = ws.save(texts.mapInArrow(_leaves, "id long, leaves array<long>").where("size(leaves) > 0"), "leaves")
    held = scan.select("id", F.explode("leaves").alias("leaf"))
    hot = held.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("leaf")
    hits = ws.save(held.join(hot, "leaf", "left_semi").groupBy("id").agg(F.collect_set("leaf").alias("leaves")), "hits")
    free_shuffles(docs.sparkSession)
    lines = ws.save(texts.join(hits.hint("merge"), "id").mapInArrow(_hot_lines, "id long, leaf long, name long, tokens array<long>").dropDuplicates(["id", "leaf", "name"]), "lines")
    ws.drop(scan, hits)

    # Documents of each line; then of each token in its place in the leaf.
    once = ws.save(lines.groupBy("leaf", "name").agg(F.count("*").alias("n"), F.first("tokens").alias("tokens")), "distinct")
    placed = once.select("leaf", "name", "n", F.posexplode("tokens").alias("pos", "token"))
    usual = placed.groupBy("leaf", "pos", "token").agg(F.sum("n").alias("docs")).where(F.col("docs") >= min_docs).select("leaf", "pos", "token", F.lit(True).alias("fixed"))
    variable = F.lit(int(_VARIABLE.astype(np.int64)))
    fixed = F.col("fixed").isNotNull() & (F.col("token") != variable)
    templates = ws.save(
        placed.join(usual, ["leaf", "pos", "token"], "left")
        .groupBy("leaf", "name")
        .agg(
            F.bit_xor(F.when(fixed, F.xxhash64("pos", "token")).otherwise(F.xxhash64("pos"))).alias("shape"),
            F.count("*").alias("size"),
            F.sum(F.when(fixed, 1).otherwise(0)).alias("kept"),
        )
        .where(F.col("kept") >= SIMILARITY * F.col("size"))
        .select("leaf", "name", F.xxhash64("leaf", "shape").alias("template")),
        "templates",
    )
    members = lines.select("id", "leaf", "name").join(templates, ["leaf", "name"])
    known = members.select("template", "id").distinct().groupBy("template").agg(F.count("*").alias("docs"), F.min("id").alias("first")).where(F.col("docs") >= min_docs)
    out = ws.save(members.join(known, "template").where("id > first").groupBy("id").agg(F.collect_set("name").alias("names")), "dropped")
    ws.clear(out)
    return out


def _cut(at: int, columns: list[str]):
    def run(batches):
        for b in batches:
            names = b.column(b.num_columns - 1)
            has = np.flatnonzero(pc.fill_null(pc.list_value_length(names), 0).to_numpy())
            n_lines, n_dropped = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            texts = b.column(at)
            n_lines[:] = pc.fill_null(pc.count_substring(texts, "\n"), -1).to_numpy() + 1
            if len(has):
                part, drop = texts.take(pa.array(has)), names.take(pa.array(has))
                drop_doc, drop = _per_document(drop, len(has))
                new: dict[int, str] = {}
                for block in blocks(part):
                    x = Lines(block)
                    gone = _member(x.name, block.rows[x.doc], drop.view(np.uint64), drop_doc) & x.parsed
                    places, of = x.line[gone], x.doc[gone]
                    hit = np.unique(of)
                    for d, lo, hi in zip(hit.tolist(), np.searchsorted(of, hit), np.searchsorted(of, hit, side="right"), strict=True):
                        lines = block.buf[block.off[d] : block.off[d + 1]].tobytes().split(b"\n")
                        out = set(places[lo:hi].tolist())
                        r = int(has[block.rows[d]])
                        new[r] = b"\n".join([v for i, v in enumerate(lines) if i not in out]).decode()
                        n_dropped[r] = len(out)
                if new:
                    mask = np.zeros(b.num_rows, bool)
                    mask[list(new)] = True
                    texts = pc.replace_with_mask(texts, pa.array(mask), pa.array([new[r] for r in sorted(new)], texts.type))
            cols = [texts if i == at else b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines), pa.array(n_dropped)], columns)

    return run


def _applied(docs: DataFrame, id_col: str, text_col: str, min_docs: int) -> tuple[DataFrame, str, str]:
    """``docs`` cut, with two more columns, and their names."""
    ws = Workspace(docs.sparkSession, "lines")
    key, names, n_lines, n_dropped = fresh(docs.columns, "_id", "_names", "_n_lines", "_n_dropped")
    dropped = boilerplate(docs, id_col, text_col, ws, min_docs).select(F.col("id").alias(key), F.col("names").alias(names))
    # Texts are joined by a shuffle at every size: hits grow with the input.
    joined = docs.join(dropped.hint("merge"), F.col(id_col).try_cast("long") == F.col(key), "left").drop(key)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    cut = _cut(docs.columns.index(text_col), [*docs.columns, n_lines, n_dropped])
    return joined.mapInArrow(cut, f"{fields}, {n_lines} long, {n_dropped} long"), n_lines, n_dropped


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` without boilerplate lines; ``length_col`` follows the text."""
    out, _, n_dropped = _applied(docs, id_col, text_col, min_docs)
    if length_col:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.col(n_dropped) > 0, F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return out.select(*docs.columns)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row: id, ``n_lines``, ``n_dropped``, ``kept_sha256`` of the text."""
    digest: Column = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    out, n_lines, n_dropped = _applied(docs.select(id_col, text_col), id_col, text_col, min_docs)
    return out.select(id_col, F.col(n_lines).alias("n_lines"), F.col(n_dropped).alias("n_dropped"), digest.alias("kept_sha256"))
