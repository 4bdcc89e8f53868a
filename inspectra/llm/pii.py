"""Personal data: patterns propose spans, checksums confirm them, words nearby
adjust their score.

Each kind has a pattern, a validator and a score in hundredths: what the pattern
is worth alone, what a passed checksum (Luhn for cards, mod 97 for account
numbers) adds, and what a word of its context adds when it stands within
``BEFORE`` code points before or ``AFTER`` behind the span (as far as the next
proposal of the kind). Base kinds (email, ip, card, phone) stay once their
validator agrees, whatever their score; further kinds need ``THRESHOLD``.

Everything is a DataFrame expression on one row: the text is cut at a kind's
matches, lengths of the pieces are summed to offsets, arrays are filtered. There
is no shuffle and no Python. Patterns give back nothing once they have matched
(possessive), so a text of megabytes costs linear time and no stack.

Edge cases: null and empty texts have no spans; offsets are code points; very
long texts are scanned whole; ties (kinds that start together) are ordered by
kind as listed; repeated rows are scanned alike; null ids are kept; an empty table gives
an empty result; other columns are never read and may have any names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Score from which a proposal of a further kind is a span.
THRESHOLD = 50
#: Code points around a span in which context words count.
BEFORE, AFTER = 40, 20
#: Matches whose lengths are summed in one go.
_RUN = 256

#: Account number lengths by country (ISO 13616).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def _iban() -> str:
    """Account numbers of the right length, in one piece or in groups of four."""
    by = defaultdict(list)
    for country, n in sorted(IBAN_LENGTHS.items()):
        by[n].append(country)
    rest = lambda n: r"(?:\x20?[A-Z0-9]{4}){%d}" % (n // 4) + (r"\x20?[A-Z0-9]{%d}" % (n % 4) if n % 4 else "")
    return "(?:" + "|".join(f"(?:{'|'.join(c)})[0-9]{{2}}{rest(n - 4)}" for n, c in sorted(by.items(), reverse=True)) + ")"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of the value pass the Luhn check."""
    d = _digits(value)

    def add(total: Column, i: Column) -> Column:
        v = F.ascii(F.substr(d, -i, F.lit(1))) - 48
        twice = F.when(v > 4, 2 * v - 9).otherwise(2 * v)
        return total + F.when(i % 2 == 0, twice).otherwise(v)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number leaves 1: its first four characters go to the
    end, letters count from 10."""
    c = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substr(c, F.lit(5)), F.substr(c, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        v = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(v < 65, rest * 10 + v - 48).otherwise(rest * 100 + v - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def _n_digits(least: int, most: int) -> Callable[[Column], Column]:
    return lambda p: F.length(_digits(p["value"])).between(least, most)


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``valid`` decides about a proposal (``value``,
    ``before``, ``after``); ``literal`` must stand in any text with a match."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    worth: int
    checksum: Callable[[Column], Column] | None = None
    confirmed: int = 0
    context: tuple[str, ...] = ()
    near: int = 0
    literal: str | None = None


#: An address: numbers up to 255, zeros in front allowed.
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
#: No letter or digit touches the span.
_ALONE_BEFORE, _ALONE_AFTER = r"[A-Za-z0-9]$", r"^[A-Za-z0-9]"
#: What a number without a + must not continue, and not be continued by.
_NUMBER_BEFORE, _NUMBER_AFTER = r"[A-Za-z@_.]$|[+0-9][\x20().-]{0,3}$|\+[\x20().0-9-]{0,8}$", r"^(?:[\x20.-]?[0-9]|[A-Za-z@_])"

BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda p: F.lit(True),
        80,
        context=("mail", "email", "contact", "write", "kontakt", "correo", "courriel"),
        near=20,
        literal="@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        lambda p: p["value"].rlike(_OCTETS),
        60,
        context=("ip", "host", "address", "server", "client", "adresse"),
        near=20,
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+",
        lambda p: _n_digits(12, 19)(p),
        30,
        lambda p: luhn(p["value"]),
        50,
        ("card", "credit", "debit", "visa", "mastercard", "amex", "karte", "carte", "tarjeta"),
        20,
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _n_digits(9, 15), 60, context=("phone", "tel", "call", "mobile", "fax", "telefon", "telefono"), near=20, literal="+"),
)
FURTHER = (
    Kind(
        "iban",
        r"(?=[A-Z]{2}[0-9]{2}[\x20A-Z0-9])" + _iban(),
        lambda p: ~p["before"].rlike(_ALONE_BEFORE) & ~p["after"].rlike(_ALONE_AFTER),
        0,
        lambda p: mod97(p["value"]),
        80,
        ("iban", "account", "bank", "konto", "compte", "cuenta"),
        20,
    ),
    Kind(
        "local_phone",
        r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
        lambda p: ~p["before"].rlike(_NUMBER_BEFORE) & ~p["after"].rlike(_NUMBER_AFTER),
        30,
        context=("phone", "tel", "call", "mobile", "fax", "telefon", "telefono"),
        near=40,
    ),
    Kind(
        "social",
        r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        lambda p: ~p["before"].rlike(_NUMBER_BEFORE) & ~p["after"].rlike(_NUMBER_AFTER) & ~p["value"].rlike("^(?:000|666|9)|-00-|-0000$"),
        30,
        context=("ssn", "social", "taxpayer"),
        near=40,
        literal="-",
    ),
    Kind(
        "birth_date",
        r"(?:[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4})",
        lambda p: ~p["before"].rlike(_NUMBER_BEFORE) & ~p["after"].rlike(_NUMBER_AFTER),
        15,
        context=("born", "birth", "birthday", "dob", "geboren", "geburtstag", "nacido", "nacida", "naissance"),
        near=45,
    ),
)
KINDS = (*BASE, *FURTHER)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _near(words: tuple[str, ...]) -> str:
    return f"(?:^|[^a-z])(?:{'|'.join(words)})(?:[^a-z]|$)"


def _sums(x: Column) -> Column:
    """Running sums of an array of longs with an entry at least. Growing one array
    entry by entry costs the square of its length, so runs of ``_RUN`` entries are
    summed each, then their totals."""
    grow = lambda a: F.aggregate(a, F.array(F.lit(0).cast("long")), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / _RUN).cast("int")), lambda r: grow(F.slice(x, r * _RUN + 1, _RUN)))
    ahead = lambda runs: grow(F.transform(runs, lambda r: F.element_at(r, -1)))
    moved = F.transform(F.arrays_zip(runs.alias("r"), F.slice(ahead(runs), 1, F.size(runs)).alias("a")), lambda z: F.transform(F.slice(z["r"], 2, _RUN), lambda v: v + z["a"]))
    return F.flatten(moved)


def _score(kind: Kind, p: Column) -> Column:
    score = F.lit(kind.worth + (kind.confirmed if kind.checksum else 0))
    if kind.context:
        lower = lambda c: F.translate(c, _UPPER, _LOWER)
        near = lower(F.right(p["before"], F.lit(BEFORE))).rlike(_near(kind.context)) | lower(F.left(p["after"], F.lit(AFTER))).rlike(_near(kind.context))
        score = score + F.when(near, kind.near).otherwise(0)
    return score


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: id and ``spans``, an array of (kind, start, end,
    score) by start, then kind in the order of ``kinds``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    none = F.array().cast("array<string>")
    found = lambda k: F.regexp_extract_all("t", F.lit(k.pattern), 0)
    rows = rows.select("*", *((F.when(F.contains("t", F.lit(k.literal)), found(k)).otherwise(none) if k.literal else found(k)).alias(f"m{i}") for i, k in enumerate(kinds)))
    rows = rows.select("id", *(f"m{i}" for i in range(len(kinds))), *(F.when(F.size(f"m{i}") > 0, F.split("t", k.pattern, -1)).alias(f"s{i}") for i, k in enumerate(kinds)))
    length = lambda i: F.zip_with(F.slice(f"s{i}", 1, F.size(f"m{i}")), f"m{i}", lambda s, m: (F.length(s) + F.length(m)).cast("long"))
    rows = rows.select("*", *(F.when(F.size(f"m{i}") > 0, length(i)).alias(f"l{i}") for i in range(len(kinds))))
    rows = rows.select("*", *(F.when(F.size(f"m{i}") > 0, _sums(F.col(f"l{i}"))).alias(f"e{i}") for i in range(len(kinds))))

    def spans(i: int, kind: Kind) -> Column:
        m, s = F.col(f"m{i}"), F.col(f"s{i}")
        each = F.arrays_zip(m.alias("value"), F.col(f"e{i}").alias("end"), F.slice(s, 1, F.size(m)).alias("before"), F.slice(s, 2, F.size(m)).alias("after"))
        holds = lambda p: kind.valid(p) & (kind.checksum(p) if kind.checksum else F.lit(True))
        scored = F.transform(
            F.filter(each, holds),
            lambda p: F.struct((p["end"] - F.length(p["value"])).alias("start"), F.lit(i).alias("rank"), p["end"].alias("end"), _score(kind, p).alias("score")),
        )
        return scored if kind in BASE else F.filter(scored, lambda p: p["score"] >= threshold)

    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,score:int>>")
    every = F.concat(*(F.when(F.size(f"m{i}") > 0, spans(i, k)).otherwise(empty) for i, k in enumerate(kinds)))
    names = F.array(*(F.lit(k.name) for k in kinds))
    out = F.transform(F.array_sort(every), lambda p: F.struct(F.element_at(names, p["rank"] + 1).alias("kind"), p["start"].alias("start"), p["end"].alias("end"), p["score"].alias("score")))
    return rows.select(F.col("id").alias(id_col), out.alias("spans"))


#: Patterns of the base kinds as a contract states them, for engines whose matching
#: is linear anyway.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban(),
}


def oracle(table: str = "documents") -> str:
    """The registered query as DuckDB SQL, spans as rows."""
    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    between = lambda a, b: f"length({digits}) between {a} and {b}"
    alone = f"not regexp_matches(before, '{_ALONE_BEFORE}') and not regexp_matches(after, '{_ALONE_AFTER}')"
    number = f"not regexp_matches(before, '{_NUMBER_BEFORE}') and not regexp_matches(after, '{_NUMBER_AFTER}')"
    passes = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: case when i % 2 = 0 then (2 * {digits}[-i]::int) - case when {digits}[-i]::int > 4 then 9 else 0 end else {digits}[-i]::int end)) % 10 = 0"
    moved = "(replace(value, ' ', '')[5:] || replace(value, ' ', '')[:4])"
    leaves = f"""list_reduce(list_transform(string_split({moved}, ''), lambda c: case when ascii(c) < 65 then ascii(c) - 48 else ascii(c) - 55 end),
      lambda r, v: case when v < 10 then (r * 10 + v) % 97 else (r * 100 + v) % 97 end, 0) = 1"""
    valid = {
        "email": "true", "ip": f"regexp_matches(value, '{_OCTETS}')", "card": f"{between(12, 19)} and {passes}", "phone": between(9, 15), "iban": f"{alone} and {leaves}",
        "local_phone": number, "social": f"{number} and not regexp_matches(value, '^(?:000|666|9)|-00-|-0000$')", "birth_date": number,
    }
    parts = []
    for i, k in enumerate(KINDS):
        p = _PLAIN.get(k.name, k.pattern)
        lower = lambda c: f"translate({c}, '{_UPPER}', '{_LOWER}')"
        near = f"regexp_matches({lower(f'right(before, {BEFORE})')}, '{_near(k.context)}') or regexp_matches({lower(f'left(after, {AFTER})')}, '{_near(k.context)}')"
        parts.append(
            f"""select r, {i} as rank, '{k.name}' as kind, stop - length(value) as start, stop from (
          select *, sum(length(before) + length(value)) over (partition by r order by i)::bigint as stop from (
            select r, unnest(m) as value, unnest(s[:len(m)]) as before, unnest(s[2:]) as after, generate_subscripts(m, 1) as i
            from (select r, regexp_extract_all(t, '{p}') as m, regexp_split_to_array(t, '{p}') as s from d)))
          where ({valid[k.name]}) and ({str(k in BASE).lower()} or {k.worth + k.confirmed} + case when {near} then {k.near} else 0 end >= {THRESHOLD})"""
        )
    text = lambda where: f"coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) filter (where {where}), '')"
    return f"""with d as (select row_number() over () as r, doc_id, coalesce("text", '') as t from {table}), s as ({" union all ".join(parts)})
      select doc_id, {", ".join(f"count(*) filter (where kind = '{k.name}') as n_{k.name}" for k in BASE)}, sha256({text(f"rank < {len(BASE)}")}) as base_sha256, {text("rank is not null")} as spans
      from d left join s using (r) group by r, doc_id"""
