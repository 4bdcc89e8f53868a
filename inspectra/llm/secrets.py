"""Secret scans: fixed patterns plus automata inferred from known credentials.

Grammar inference after Carrasco and Oncina: a prefix tree of labelled
credentials, whose states are merged while their outgoing and final frequencies
agree within a Hoeffding bound, gives one probabilistic automaton per kind of
credential.  Every token that could be a credential is scored by its likelihood
under the automata against that under an automaton of ordinary words; tokens
above the calibrated ratio become further spans.

The credentials are labelled by the base patterns themselves, which name their
kind; ordinary tokens are all other candidates, numbers included, and tokens of
formats that carry no secret whether the table holds any or not (``ordinary``).
A candidate is any run of 8 or more credential characters; its evidence (the
log-likelihood ratio of the whole token) must outweigh prior odds of one
credential in ``ODDS`` tokens, and be more than that of all but one in 500
ordinary tokens that were held out, so the bound is the same for tables of every
size unless ordinary tokens reach it.

Edge cases: null and empty texts have no spans; offsets are code points; very
long texts and tokens are read whole; repeated rows are scanned alike; with no
labelled credential no span is added; an empty table gives an empty result; null
ids are kept.  Other columns are never read and may have any names.
"""

from __future__ import annotations

import math
import random
import re
import uuid
import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.A)
HEX = re.compile(r"[0-9a-f]+", re.A)
#: The same runs as HEX where they are long enough; shorter ones never count.
_HEX_LONG = re.compile(r"[0-9a-f]{32,}", re.A)
KINDS = ("assign", "access", "hex")
#: Name of the spans that the automata add.
INFERRED = "format"
#: Runs of credential characters; dots and slashes at the ends are prose.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{6,}[A-Za-z0-9+/_=-]", re.A)

#: Bounds of the fitting sample (tokens of least hash over the whole table):
#: credentials per kind, ordinary tokens, and symbols of either.
FIT_CREDENTIALS, FIT_WORDS, FIT_SYMBOLS = 2000, 4000, 200_000
#: Tokens made of each ordinary format.
FIT_ORDINARY = 800
ALPHA = 0.05
#: Prior odds against a token being a credential.
ODDS = 1e6
#: Tokens whose verdict a worker remembers; beyond it forgets them all.
REMEMBER = 200_000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base matches, sorted by start and kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX_LONG.finditer(text)]
    found.sort()
    return found


#: Symbol classes; letters of the access prefix stay themselves.
_CLASS = {c: c for c in "AKI+/_.=-"}
_CLASS |= dict.fromkeys("abcdef", "x") | dict.fromkeys("ghijklmnopqrstuvwxyz", "l")
_CLASS |= dict.fromkeys("BCDEF", "X") | dict.fromkeys("GHJLMNOPQRSTUVWYZ" + "X", "U") | dict.fromkeys("0123456789", "d")
_CLASSES = str.maketrans(_CLASS)
_SYMBOLS = len(set(_CLASS.values()))


class Automaton:
    """Deterministic stochastic automaton by state merging."""

    def __init__(self, samples: list[str], alpha: float = ALPHA):
        self._grow(samples)
        self._merge(alpha)
        self._freeze()

    def _grow(self, samples: list[str]) -> None:
        """Prefix tree: visits, ends, transitions and their frequencies."""
        self.count, self.final, self.next, self.freq = [0], [0], [{}], [{}]
        for s in samples:
            at = 0
            self.count[0] += 1
            for c in s:
                to = self.next[at].get(c)
                if to is None:
                    to = self.next[at][c] = len(self.count)
                    self.count.append(0)
                    self.final.append(0)
                    self.next.append({})
                    self.freq.append({})
                self.freq[at][c] = self.freq[at].get(c, 0) + 1
                self.count[to] += 1
                at = to
            self.final[at] += 1

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        todo, seen = [(a, b)], set()
        while todo:
            pair = todo.pop()
            if pair in seen:
                continue
            seen.add(pair)
            a, b = pair
            n1, n2 = self.count[a], self.count[b]
            most = bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
            if abs(self.final[a] / n1 - self.final[b] / n2) > most:
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                if abs(self.freq[a].get(c, 0) / n1 - self.freq[b].get(c, 0) / n2) > most:
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b into a; b's states all hang on one parent."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.final[a] += self.final[b]
            for c, y in self.next[b].items():
                self.freq[a][c] = self.freq[a].get(c, 0) + self.freq[b][c]
                if c in self.next[a]:
                    todo.append((self.next[a][c], y))
                else:
                    self.next[a][c] = y

    def _merge(self, alpha: float) -> None:
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        red = [0]
        while True:
            kept = set(red)
            blue = [(-self.freq[r][c], r, c) for r in red for c, to in self.next[r].items() if to not in kept]
            if not blue:
                break
            _, at, c = min(blue)  # the most used one; ties by place
            state = self.next[at][c]
            for r in red:
                if self._compatible(r, state, bound):
                    self.next[at][c] = r
                    self._fold(r, state)
                    break
            else:
                red.append(state)
        self.red = red

    def _freeze(self) -> None:
        place = {r: i for i, r in enumerate(self.red)}
        self.states, self.miss = [], []
        for r in self.red:
            total = self.count[r] + 0.5 * (_SYMBOLS + 1)
            self.states.append({c: (math.log((self.freq[r][c] + 0.5) / total), place[to]) for c, to in self.next[r].items()})
            self.miss.append(math.log(0.5 / total))
        del self.count, self.final, self.next, self.freq, self.red

    def score(self, token: str) -> float:
        """Mean log-likelihood of a symbol; an unseen one restarts."""
        at, total, states = 0, 0.0, self.states
        for c in token:
            got = states[at].get(c)
            if got is None:
                total += self.miss[at]
                at = 0
            else:
                total += got[0]
                at = got[1]
        return total / max(1, len(token))


def _bounded(values: list[str]) -> list[str]:
    """The first values whose symbols stay within the bound, one at least."""
    out, left = [], FIT_SYMBOLS
    for v in values:
        left -= len(v)
        if left < 0 and out:
            break
        out.append(v)
    return out


def ordinary(n: int = FIT_ORDINARY) -> dict[str, list[str]]:
    """Tokens of formats that carry no secret, the same at each call: unique ids,
    numbers of 8 to 24 digits (grouped or not), dates and times."""
    rng = random.Random(0)
    number = lambda k: "".join(rng.choices("0123456789", k=k))
    pick = lambda *f: rng.choice(f)()
    day = lambda: f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
    return {
        "uuid": [str(uuid.UUID(int=rng.getrandbits(128), version=rng.choice((1, 4, 5)))) for _ in range(n)],
        "number": [pick(lambda: number(rng.randint(8, 24)), lambda: "-".join(number(4) for _ in range(rng.randint(2, 5)))) for _ in range(n)],
        "date": [pick(day, lambda: f"{day()}T{rng.randint(0, 23):02}", lambda: day().replace("-", "") + f"T{number(6)}Z") for _ in range(n)],
    }


class FormatModel:
    """Automata of the kinds, of ordinary words, of other ordinary tokens of the
    table (addresses, numbers) and of each ordinary format, and the evidence that
    a credential needs. A quarter of each sample is held out to calibrate it."""

    def __init__(self, credentials: dict[str, list[str]], words: list[str]):
        shape = lambda x: [t.translate(_CLASSES) for t in x]
        self.kinds, self.plain, self.needed, self._verdicts = [], [], math.inf, {}
        for _, values in sorted(credentials.items()):
            values = sorted(set(_bounded(values)))
            if len(values) < 4:
                continue
            self.kinds.append(Automaton(shape([v for i, v in enumerate(values) if i % 4])))
        strata = [sorted(set(_bounded([w for w in words if w.isalpha() == plain]))) for plain in (True, False)]
        strata = [x for x in strata if len(x) >= 4] + [sorted(set(x)) for x in ordinary().values()]
        if not self.kinds:
            return
        self.plain = [Automaton(shape([w for i, w in enumerate(x) if i % 4])) for x in strata]
        bad = sorted(self.evidence(w) for x in strata for w in x[::4])
        self.needed = max(math.log(ODDS), bad[-1 - len(bad) // 500] + 1)

    def evidence(self, token: str) -> float:
        """Log-likelihood ratio of the token: best kind against best ordinary format."""
        t = token.translate(_CLASSES)
        return (max(k.score(t) for k in self.kinds) - max(k.score(t) for k in self.plain)) * len(t)

    def spans(self, text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Further spans: candidates with enough evidence that no base span meets."""
        if not self.kinds:
            return []
        found, at = [], 0
        for m in CANDIDATE.finditer(text):
            if not self.known(m.group()):
                continue
            s, e = m.span()
            while at < len(taken) and taken[at][2] <= s:
                at += 1
            i = at
            while i < len(taken) and taken[i][0] < e and taken[i][2] <= s:
                i += 1
            if i == len(taken) or taken[i][0] >= e:
                found.append((s, len(KINDS), e))
        return found

    def known(self, token: str) -> bool:
        got = self._verdicts.get(token)
        if got is None:
            if len(self._verdicts) >= REMEMBER:
                self._verdicts.clear()
            got = self._verdicts[token] = self.evidence(token) >= self.needed
        return got


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> FormatModel:
    """Automata from at most FIT_CREDENTIALS values of each kind and FIT_WORDS
    ordinary words and other tokens each, those with the least hashes over the whole table: tasks
    write a bounded number each, once, and a top-k picks among them."""

    def gather(batches):
        best: dict[str, dict[str, int]] = defaultdict(dict)
        key = lambda v: zlib.crc32(v.encode("utf-8", "surrogatepass"))
        cut: dict[str, int] = {}

        def put(kind: str, value: str, most: int) -> None:
            k = key(value)
            if k <= cut.get(kind, 1 << 32):
                best[kind][value] = k
                if len(best[kind]) > 2 * most:
                    best[kind] = dict(sorted(best[kind].items(), key=lambda x: (x[1], x[0]))[:most])
                    cut[kind] = max(best[kind].values())

        for b in batches:
            for text in b.column("_text").to_pylist():
                if not text:
                    continue
                spans = base_spans(text)
                for s, kind, e in spans:
                    put(KINDS[kind], ASSIGN.match(text, s).group(2) if kind == 0 else text[s:e], FIT_CREDENTIALS)
                if spans:
                    # What is labelled is no ordinary token, nor what touches it.
                    last = 0
                    for s, _, e in [*spans, (len(text), 0, len(text))]:
                        for value in CANDIDATE.findall(text[last:s]) if s > last else ():
                            put("word" if value.isalpha() else "other", value, FIT_WORDS)
                        last = max(last, e)
                else:
                    for value in set(CANDIDATE.findall(text)):
                        put("word" if value.isalpha() else "other", value, FIT_WORDS)
        rows = [(k, v, h) for k, values in best.items() for v, h in values.items()]
        for i in range(0, len(rows), 5000):
            part = rows[i : i + 5000]
            yield pa.RecordBatch.from_pydict({"kind": [r[0] for r in part], "value": [r[1] for r in part], "h": [r[2] for r in part]})

    ws = Workspace(docs.sparkSession, "secrets")
    texts = docs.select(F.col(text_col).alias("_text")).where(F.length("_text") > 0)
    got = ws.save(texts.mapInArrow(gather, "kind string, value string, h long").dropDuplicates(), "gathered")
    by: dict[str, list[str]] = defaultdict(list)
    for kind in (*KINDS, "word", "other"):
        top = got.where(F.col("kind") == kind).orderBy("h", "value").limit(FIT_CREDENTIALS if kind in KINDS else FIT_WORDS)
        by[kind] = [r.value for r in top.select("value").collect()]
    ws.clear()
    return FormatModel({k: by[k] for k in KINDS}, by["word"] + by["other"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: FormatModel | None = None) -> DataFrame:
    """One row per document: id and ``spans``, an array of (kind, start, end)
    sorted by start, then kind in the order of KINDS with inferred ones last."""
    model = model or fit(docs, id_col, text_col)
    names = (*KINDS, INFERRED)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def find(batches):
        for b in batches:
            out = []
            for text in b.column("_text").to_pylist():
                base = base_spans(text) if text else []
                every = sorted(base + model.spans(text, base)) if text else []
                out.append([{"kind": names[k], "start": s, "end": e} for s, k, e in every])
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(out, pa.list_(span))], [id_col, "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        find, f"{id_col} {kind}, spans array<struct<kind: string, start: long, end: long>>"
    )
