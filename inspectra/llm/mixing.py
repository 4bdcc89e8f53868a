"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (source, language, topic) first; the fit then
runs on the cells' token sums alone, so a source with a third of all rows is a
few cells.  Each round rakes the weights to one marginal after the other with
window sums, until the largest gap between a marginal and its target is below
``TOLERANCE`` or shrinks no more (reported by a warning and by :func:`gap`).  A document's probability is
its cell's weight over its cell's tokens times a common scale, at most 1; what
cells at 1 cannot take goes to the others until the expected size is met or all
are full; what that leaves of the targets is told by :func:`marginals`, and by a
warning where a share is missed. With ``meet`` the sample is as large as it can be
with every target met (:func:`reachable`), at most ``keep``.  Whether a
document is drawn depends on a hash of its id alone, so a repeated run draws the
same documents.

Everything is built from DataFrame functions.

Edge cases: null sources, languages and topics are categories of their own;
null and empty texts have no tokens, weigh nothing and are not drawn; very long
texts are counted whole; rows that repeat an id are drawn or left together; an
empty table gives an empty result; a target category without tokens is left out
and the others are rescaled; columns of other names are never read, and
:func:`filter_documents` hands them on under any names.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Workspace

#: Target shares are token shares to this power, rescaled: 1 keeps the mix, 0
#: makes categories equal.
TEMPERATURE = {"source": 0.7, "lang": 0.7, "topic": 0.7}
#: Rounds of raking at least; the gap between a marginal and its target that ends
#: it; the share of tokens that the sample aims at.
ROUNDS, TOLERANCE, KEEP = 12, 1e-10, 0.6
#: A share of the expected sample that differs more from its target is told.
MISS = 0.01
#: Rounds of handing on what cells at probability 1 cannot take that the SQL
#: writes out; the operator goes on until nothing changes.
CAP_ROUNDS = 6
#: What marks a text as code, and words of licences and notices.
CODE = r"[A-Za-z_]\(|[{};]\s*\n"
LEGAL = ("icense", "LICENSE", "opyright", "COPYRIGHT", "ights reserved", "arranty")
AXES = ("source", "lang", "topic")


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """Content class of tables without one, from what stands in the text: rows of
    cells, code, licences and notices, addresses and contacts, else prose."""
    t = F.coalesce(text, F.lit(""))
    legal = F.lit(False)
    for w in LEGAL:
        legal = legal | t.contains(w)
    return (
        F.when(t.contains(" | "), "table")
        .when(t.rlike(CODE), "code")
        .when(legal, "legal")
        .when(t.contains("@") | t.contains("://"), "contact")
        .otherwise("prose")
    )


def draw(id_: Column) -> Column:
    """Uniform in [0, 1) from the id: 40 bits of its MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")), 1, 10), 16, 10).cast("double") / F.lit(float(1 << 40))


def oracle(table: str = "documents", rounds: int = ROUNDS, keep: float = KEEP) -> str:
    """The same sample as DuckDB SQL, the rounds written out."""
    w = r"[^\x20\x09-\x0D]+"
    ctes = [
        f"""m as (select doc_id, source, lang, coalesce(len(regexp_extract_all("text", '{w}')), 0)::bigint n_tokens,
          case when contains(coalesce("text", ''), ' | ') then 'table'
               when regexp_matches(coalesce("text", ''), '{CODE}') then 'code'
               when {" or ".join(f"contains(coalesce(text, ''), '{w}')" for w in LEGAL)} then 'legal'
               when contains(coalesce("text", ''), '@') or contains(coalesce("text", ''), '://') then 'contact' else 'prose' end topic from {table})""",
        "c as (select source, lang, topic, sum(n_tokens)::double n_tokens from m group by all having sum(n_tokens) > 0)",
    ]
    for a in AXES:
        ctes.append(f"s_{a} as (select {a}, pow(sum(n_tokens), {TEMPERATURE[a]}) p from c group by all)")
        ctes.append(f"t_{a} as (select {a}, p / (select sum(p) from s_{a}) t from s_{a})")
    join = " ".join(f"join t_{a} on c.{a} is not distinct from t_{a}.{a}" for a in AXES)
    ctes.append(f"w0 as (select c.*, c.n_tokens / (select sum(n_tokens) from c) weight, {', '.join(f't_{a}.t t_{a}' for a in AXES)} from c {join})")
    n = 0
    for _ in range(rounds):
        for a in AXES:
            ctes.append(f"w{n + 1} as materialized (select * replace (weight * t_{a} / sum(weight) over (partition by {a}) as weight) from w{n})")
            n += 1
    ctes.append("g0 as (select 0::double scale)")
    for r in range(CAP_ROUNDS):
        ctes.append(
            f"g{r + 1} as materialized (select greatest(any_value(g.scale), coalesce(({keep} * sum(n_tokens) - sum(case when weight / n_tokens * g.scale >= 1 then n_tokens else 0 end))"
            f" / nullif(sum(case when weight / n_tokens * g.scale >= 1 then 0 else weight end), 0), any_value(g.scale))) scale from w{n}, g{r} g)"
        )
    ctes.append(f"p as (select source, lang, topic, round(least(1, weight / n_tokens * scale), 9) probability from w{n}, g{CAP_ROUNDS})")
    on = " and ".join(f"m.{a} is not distinct from p.{a}" for a in AXES)
    u = "('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 10))::bigint::double / (1::bigint << 40)"
    return f"""with {", ".join(ctes)}
      select doc_id, m.source, m.lang, m.topic, m.n_tokens, case when m.n_tokens > 0 then coalesce(probability, 0) else 0 end probability,
             {u} < case when m.n_tokens > 0 then coalesce(probability, 0) else 0 end sampled
      from m left join p on {on}"""


def cells(docs: DataFrame) -> DataFrame:
    """``source, lang, topic`` with ``n_docs`` and ``n_tokens``."""
    return docs.groupBy(*AXES).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def _share(axis: str, target: dict | None) -> Column:
    """Unscaled target share of a category with ``total`` tokens."""
    if target is None:
        return F.pow(F.col("total").cast("double"), F.lit(TEMPERATURE[axis]))
    out = F.lit(0.0)
    for k, v in target.items():
        out = F.when(F.col(axis).eqNullSafe(F.lit(k)), F.lit(float(v))).otherwise(out)
    return out


def _number(df: DataFrame, *what: Column) -> tuple[float, ...]:
    """Totals of a table, as plain numbers."""
    return tuple(float(x or 0.0) for x in df.agg(*what).first())


def gap(fitted: DataFrame) -> float:
    """Largest difference between a marginal of the weights and its target."""
    gaps = [fitted.groupBy(a).agg(F.abs(F.sum("weight") - F.first(f"t_{a}")).alias("gap")).select("gap") for a in AXES]
    every = gaps[0].unionAll(gaps[1]).unionAll(gaps[2])
    return _number(every, F.max("gap"))[0]


def rake(c: DataFrame, ws: Workspace, targets: dict[str, dict] | None = None, rounds: int = ROUNDS, strict: bool = False) -> DataFrame:
    """``weight`` per cell: token mass (summing to 1) fitted to the marginals,
    with the targets as ``t_<axis>``.

    ``targets`` may name shares by axis; other axes use TEMPERATURE. At least
    ``rounds`` rounds, then on while the gap is above TOLERANCE and halves in
    three rounds; where it does not (cells that are missing can make targets
    contradict each other), the weights so far are the fit, with a warning, or
    an error if ``strict``."""
    live = c.where("n_tokens > 0")
    (total,) = _number(live, F.sum("n_tokens"))
    live = live.withColumn("weight", F.col("n_tokens") / F.lit(total or 1.0))
    for a in AXES:
        share = live.groupBy(a).agg(F.sum("n_tokens").alias("total")).where("total > 0").withColumn("share", _share(a, (targets or {}).get(a)))
        (scale,) = _number(share, F.sum("share"))
        own = Window.partitionBy(a)
        live = live.withColumn("total", F.sum("n_tokens").over(own)).withColumn(f"t_{a}", _share(a, (targets or {}).get(a)) / F.lit(scale or 1.0)).drop("total")
    live, done, before = ws.save(live, "cells"), 0, math.inf
    while True:
        nxt, step = live, min(3, rounds - done) if done < rounds else 3
        for _ in range(step):
            for a in AXES:
                have = F.sum("weight").over(Window.partitionBy(a))
                nxt = nxt.withColumn("weight", F.when(have > 0, F.col("weight") * F.col(f"t_{a}") / have).otherwise(F.lit(0.0)))
        nxt = ws.save(nxt, "raked")
        ws.drop(live)
        live, done = nxt, done + step
        if done < rounds - 3:
            continue
        now = gap(live)
        if done >= rounds and (now <= TOLERANCE or now > before / 2):
            break
        before = now
    if now > TOLERANCE:
        text = f"the marginals cannot be met together: a gap of {now:.3g} after {done} rounds"
        if strict:
            raise ValueError(text)
        warnings.warn(text, stacklevel=2)
    return live


def reachable(fitted: DataFrame) -> float:
    """The largest share of all tokens that a sample can hold while no cell has to
    give more than it has."""
    (total,) = _number(fitted, F.sum("n_tokens"))
    (most,) = _number(fitted.where("weight > 0"), F.min(F.col("n_tokens") / F.col("weight")))
    return min(1.0, most / total) if total else 1.0


def probabilities(fitted: DataFrame, keep: float = KEEP) -> DataFrame:
    """``probability`` per cell: proportional to weight over tokens, scaled so
    that the expected sample holds ``keep`` of all tokens; what cells at 1
    cannot take is handed to the others until the scale stays."""
    ratio, scale = F.col("weight") / F.col("n_tokens"), 0.0
    (total,) = _number(fitted, F.sum("n_tokens"))
    while True:
        full = ratio * F.lit(scale) >= 1
        taken, mass = _number(fitted, F.sum(F.when(full, F.col("n_tokens")).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))))
        larger = max(scale, (keep * total - taken) / mass) if mass > 0 else scale
        if larger <= scale * (1 + 1e-15):
            break
        scale = larger
    targets = [f"t_{a}" for a in AXES if f"t_{a}" in fitted.columns]
    return fitted.select(*AXES, "n_docs", "n_tokens", "weight", *targets, F.round(F.least(F.lit(1.0), ratio * F.lit(scale)), 9).alias("probability"))


def marginals(p: DataFrame) -> DataFrame:
    """Per axis and category of fitted cells: the target share of tokens, the
    raked share, and the share of the expected sample (which falls short of the
    target where cells are at probability 1)."""
    expected = F.col("n_tokens") * F.col("probability")
    (size,) = _number(p, F.sum(expected))
    parts = [
        p.groupBy(F.lit(a).alias("axis"), F.col(a).cast("string").alias("category")).agg(
            F.first(f"t_{a}").alias("target"), F.sum("weight").alias("raked"), (F.sum(expected) / F.lit(size or 1.0)).alias("expected"), F.max(F.col("probability") >= 1).alias("capped")
        )
        for a in AXES
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def missed(p: DataFrame) -> list[str]:
    """The categories whose share of the expected sample misses the target by
    more than MISS of it, worst first."""
    off = F.abs(F.col("expected") - F.col("target"))
    worst = marginals(p).where(off > MISS * F.col("target")).orderBy(off.desc(), "axis", "category").limit(10).collect()
    return [f"{r.axis} {r.category}: {r.expected:.4f} for {r.target:.4f}" for r in worst]


def _measures(text_col: str, source_col: str, lang_col: str, topic: Column | None) -> list[Column]:
    text = F.col(text_col)
    return [
        F.col(source_col).alias("source"),
        F.col(lang_col).alias("lang"),
        (topic if topic is not None else topic_of(text)).alias("topic"),
        tokens(text).alias("n_tokens"),
    ]


def _fitted(measured: DataFrame, ws: Workspace, targets: dict[str, dict] | None, keep: float, meet: bool) -> DataFrame:
    """Probabilities of the cells of measured documents."""
    raked = rake(ws.save(cells(measured), "counts"), ws, targets)
    p = ws.save(probabilities(raked, min(keep, reachable(raked)) if meet else keep), "probabilities")
    if off := missed(p):
        warnings.warn(f"the sample misses its targets, as some cells are drawn whole: {'; '.join(off)}", stacklevel=3)
    return p


def _cell(t: str) -> Column:
    """A cell's key without nulls; there are as few as there are categories."""
    return F.struct(*(F.coalesce(F.concat(F.lit("+"), F.col(f"{t}.{a}")), F.lit("-")).alias(a) for a in AXES))


def sample(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    targets: dict[str, dict] | None = None,
    keep: float = KEEP,
    meet: bool = False,
) -> DataFrame:
    """One row per document: id, source, lang, topic, ``n_tokens``,
    ``probability``, ``sampled``."""
    ws = Workspace(docs.sparkSession, "mixing")
    measured = ws.save(docs.select(F.col(id_col).alias(id_col), *_measures(text_col, source_col, lang_col, topic)), "measured")
    p = _fitted(measured, ws, targets, keep, meet)
    joined = measured.alias("m").join(p.alias("p"), _cell("m") == _cell("p"), "left")
    chance = F.when(F.col("m.n_tokens") > 0, F.coalesce("p.probability", F.lit(0.0))).otherwise(F.lit(0.0))
    return joined.select(
        F.col(f"m.{id_col}").alias(id_col), "m.source", "m.lang", "m.topic", "m.n_tokens", chance.alias("probability"), (draw(F.col(f"m.{id_col}")) < chance).alias("sampled")
    )


def filter_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    targets: dict[str, dict] | None = None,
    keep: float = KEEP,
    meet: bool = False,
) -> DataFrame:
    """The documents that are drawn, all columns kept. Texts meet the cells'
    small table where they are read; they are not shuffled for it."""
    ws = Workspace(docs.sparkSession, "mixing")
    measures = _measures(text_col, source_col, lang_col, topic)
    p = _fitted(docs.select(*measures), ws, targets, keep, meet)
    # Words were counted once; here a text needs its cell, and any word at all.
    cell = F.struct(*measures[:3])
    rows = docs.select(F.struct(*docs.columns).alias("row"), cell.alias("m"), draw(F.col(id_col)).alias("u"), F.col(text_col).rlike(r"[^\x20\x09-\x0D]").alias("filled"))
    joined = rows.join(p.alias("p"), _cell("m") == _cell("p"))
    return joined.where("filled and u < p.probability").select("row.*")
