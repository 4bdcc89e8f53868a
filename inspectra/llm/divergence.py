"""Source divergence audit: how far the sources of a language are from each other.

Terms are counted per (language, source) where the texts are read; a language
keeps the terms that enough of its documents hold. Every group gives every kept
term a smoothed share ``p``, and two groups differ by the sum of
``floor((p - q)^2 / (p + q))`` over all kept terms.

The pairs of groups are worked out in a cube. Groups of a language are dealt to
blocks, terms to blocks too; a task owns a cell (group block, group block, term
block). A slice (group block, term block) is replicated to the cells of its group
block, a cell computes the partial divergences of its pairs over the terms that
stand in its slices, and the partials are summed along the term axis. Terms that
neither group of a pair holds have the same ``f`` each, so only their number is
needed. A source with a third of all rows is one column of its cells, cut by the
term blocks like any other.

All arithmetic is exact: counts are longs, shares are divided as decimals,
``(p - q)^2`` stays below 2^63.

Edge cases: null texts, languages and sources count as ''; groups without terms
are groups still; a language without kept terms has divergences of 0 and no terms
to report; a language of one source has no pairs; rows that repeat an id count
each; very long texts are read whole, a slice at a time; an empty table gives an
empty result; ties are ranked by the item's UTF-8 bytes; other columns are never
read and may have any names.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

#: Documents of a language that a term needs; ranks of the term part.
MIN_DOCS, TOP_TERMS = 10, 10
#: Groups of a block (about), rows of a slice (about), term blocks at least.
GROUP_BLOCK, SLICE_ROWS, TERM_BLOCKS = 16, 50_000, 8
#: Terms that a task counts before it hands its sums on; bytes of text read at once.
FLUSH, READ_BYTES = 400_000, 1 << 20

#: In UTF-8: ASCII letters and every byte of a longer character.
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^A-Za-z\x80-\xff]")
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _terms(text: bytes):
    """Lists of a text's terms, from slices that end between terms."""
    at = 0
    while at < len(text):
        end = at + READ_BYTES
        if end < len(text):
            gap = _GAP.search(text, end)
            end = gap.start() if gap else len(text)
        yield _TERM.findall(text[at:end].lower())
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` of ``docs(lang, source, text)``: occurrences
    and documents, summed in the tasks before they are shuffled."""

    def rows(sums):
        for (lang, source), (n, d) in sums.items():
            keys = list(n)
            for i in range(0, len(keys), 50_000):
                part = keys[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array([source] * len(part), pa.string()),
                        pa.array(part, pa.binary()).cast(pa.string()),
                        pa.array([n[k] for k in part], pa.int64()),
                        pa.array([d[k] for k in part], pa.int64()),
                    ],
                    schema=_COUNTS,
                )

    def gather(batches):
        sums, size = {}, 0
        for b in batches:
            for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "text"))):
                if not text:
                    continue
                n, d = sums.setdefault((lang, source), (Counter(), Counter()))
                before, seen = len(n), set()
                for words in _terms(text.encode()):
                    n.update(words)
                    seen.update(words)
                d.update(seen)
                size += len(n) - before
                if size >= FLUSH:
                    yield from rows(sums)
                    sums, size = {}, 0
        yield from rows(sums)

    found = docs.select("lang", "source", "text").mapInArrow(gather, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str = "v") -> Column:
    """``1 + floor(10^9 (count + 2) / (total + 2 terms))``, exactly."""
    return F.expr(f"1 + (cast(1000000000 as decimal(10, 0)) * cast({count} + 2 as decimal(20, 0))) div cast({total} + 2 * {terms} as decimal(20, 0))")


def _cell(t: pa.Table) -> pa.Table:
    """Partial divergences of a cell's pairs. Rows without a term name the groups
    of both slices and their shares of terms that they do not hold."""
    i, j = t["i"][0].as_py(), t["j"][0].as_py()
    source = t["source"].combine_chunks().dictionary_encode()
    term = t["term"].combine_chunks().dictionary_encode()
    names, group = source.dictionary, source.indices.to_numpy(zero_copy_only=False)
    held = np.asarray(term.is_valid())
    p = t["p"].fill_null(0).to_numpy()
    block = t["block"].to_numpy()
    base, at = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    base[group[~held]], at[group[~held]] = p[~held], block[~held]
    shares = np.repeat(base[None], len(term.dictionary), axis=0)
    shares[term.indices.filter(pa.array(held)).to_numpy(zero_copy_only=False), group[held]] = p[held]
    # A pair has one order in all cells: by block, within a block by name.
    by_name = np.array(sorted(range(len(names)), key=names.to_pylist().__getitem__), np.int64)
    first, second = by_name[at[by_name] == i], by_name[at[by_name] == j]
    a, b, sums = [], [], []
    for n, x in enumerate(first):
        other = second[n + 1 :] if i == j else second
        q, own = shares[:, other], shares[:, x : x + 1]
        apart = q - own
        sums.append((apart * apart // (q + own)).sum(axis=0))
        a.append(np.full(len(other), x))
        b.append(other)
    a, b = np.concatenate(a or [first]), np.concatenate(b or [first])
    n = len(a)
    return pa.table(
        {
            "lang": pa.array([t["lang"][0].as_py()] * n, pa.string()),
            "a": names.take(pa.array(a)),
            "b": names.take(pa.array(b)),
            "s": pa.array(np.concatenate(sums or [first]).astype(np.int64)),
            "t": pa.array(np.full(n, len(shares)), pa.int64()),
            "pa": pa.array(base[a]),
            "pb": pa.array(base[b]),
        }
    )


def _partials(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """Partial divergences of all cells from ``entries(lang, source, term, p)``
    joined with their groups, and from the groups themselves."""
    slot = F.pmod(F.xxhash64("term"), F.col("slices"))
    cells = ("lang", "source", "block", "blocks")
    rows = entries.select(*cells, slot.alias("k"), "term", "p")
    roster = groups.select(*cells, F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("k"), F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"))
    dealt = rows.unionByName(roster).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("lang", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "k", "source", "block", "term", "p")
    return dealt.groupBy("lang", "i", "j", "k").applyInArrow(_cell, "lang string, a string, b string, s long, t long, pa long, pb long")


def audit(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    group_block: int = GROUP_BLOCK,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: per group its divergence from
    every other source of the language (part ``pair``) and the terms that it uses
    most beyond the language's share (part ``term``, ranks up to ``top``)."""
    ws = Workspace(docs.sparkSession, "divergence")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    docs = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    w = Window.partitionBy("lang", "term")
    counts = count_terms(docs).withColumn("lang_docs", F.sum("docs").over(w)).withColumn("lang_n", F.sum("n").over(w)).withColumn("lead", F.min("source").over(w))
    kept = ws.save(counts.where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", (F.col("source") == F.col("lead")).cast("long").alias("lead")), "kept")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("lead").alias("lead"), F.count("*").alias("rows"))
    own = Window.partitionBy("lang")
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").fillna(0, ["total", "lead", "rows"])
    groups = groups.withColumn("v", F.sum("lead").over(own)).withColumn("lang_total", F.sum("total").over(own)).withColumn("rows", F.sum("rows").over(own))
    groups = groups.withColumn("blocks", F.ceil(F.count("*").over(own) / F.lit(group_block)))
    groups = groups.withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks"))).withColumn("slices", F.greatest(F.lit(TERM_BLOCKS).cast("long"), F.ceil(F.col("rows") / (F.col("blocks") * slice_rows))))
    groups = ws.save(groups.withColumn("p0", F.when(F.col("v") > 0, share("0", "total"))).drop("lead", "rows"), "groups")
    entries = kept.join(groups, ["lang", "source"]).withColumn("p", share("n", "total"))

    apart = "((p - q) * (p - q)) div (p + q)"
    pairs = _partials(entries, groups).groupBy("lang", "a", "b").agg(F.sum("s").alias("s"), F.sum("t").alias("t"), F.max("pa").alias("p"), F.max("pb").alias("q"))
    pairs = pairs.join(groups.groupBy("lang").agg(F.max("v").alias("v")), "lang").withColumn("value", F.when(F.col("v") > 0, F.col("s") + (F.col("v") - F.col("t")) * F.expr(apart)).otherwise(F.lit(0).cast("long")))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    terms = entries.withColumn("q", share("lang_n", "lang_total")).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(apart).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top))


def oracle(table: str = "documents", min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> str:
    """The same rows as DuckDB SQL."""
    p = lambda n, total: f"1 + (1000000000::hugeint * ({n} + 2)) // ({total} + 2 * v)"
    apart = "(((p - q) * (p - q)) // (p + q))"
    return rf"""with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
        translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from {table}),
      w as (select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
      k as (select lang, term, count(*) as lang_n from w group by all having count(distinct r) >= {min_docs}),
      c as (select lang, source, term, count(*) as n from w semi join k using (lang, term) group by all),
      g as (select distinct lang, source from d),
      v as (select lang, count(*) as v, sum(lang_n) as lang_total from k group by 1),
      s as (select g.lang, g.source, v.v, v.lang_total, coalesce(x.total, 0) as total from g join v using (lang) left join (select lang, source, sum(n) as total from c group by all) x using (lang, source)),
      e as (select s.lang, s.source, k.term, coalesce(c.n, 0) as n, {p("coalesce(c.n, 0)", "total")} as p, {p("lang_n", "lang_total")} as q from s join k using (lang) left join c using (lang, source, term)),
      f as (select a.lang, a.source, b.source as item, sum({apart.replace("p", "a.p").replace("q", "b.p")}) as value from e a join e b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
      pair as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::bigint as value
        from g a join g b on a.lang = b.lang and a.source <> b.source left join f on f.lang = a.lang and f.source = a.source and f.item = b.source),
      term as (select lang, source, 'term' as part, term as item, {apart}::bigint as value from e where n > 0 and p > q),
      every as (select * from pair union all select * from term)
      select * from (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from every) where part = 'pair' or rank <= {top}"""
