"""Personal data by weak supervision: labelers vote on candidate spans, expectation-
maximisation estimates how far to trust each, and a span classifier decides.

One pass over the texts finds candidates: the four base kinds, which are always reported,
and looser shapes (credentials, account numbers, local telephone numbers, international account
and social security numbers, disguised mail addresses, street addresses, names behind titles),
of which many are something else. For each, labelers of three sorts vote yes, no or not at all: patterns and
check digits, gazetteers, and the words around the span. The votes and a few coarse features
make a pattern; Spark counts the patterns, whose number does not depend on the data, and on
those counts the labelers' reliabilities are estimated and the classifier is fitted.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.text import free_name, map_arrow, small_batches
from feira.plans.tables import staged

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "mail", "local_phone", "iban", "ssn", "secret", "account", "address", "name")
ACCEPT = 0.9  # probability from which a span is added to the base ones
AROUND = 40  # characters of context on either side
NEAR = 80  # characters within which a base span supports a candidate

# Base patterns. A match of `ip` or `card` can only begin where a run of digits begins.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser shapes.
MAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]{1,63}){1,4}")
LOCAL_PHONE = re.compile(r"(?<![0-9.+/-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{4}(?![0-9.-]?[0-9])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,512}={0,2}")
ACCOUNT = re.compile(r"(?<![0-9.+,/-])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9.,/-]?[0-9])")
ADDRESS = re.compile(
    r"(?<![0-9.,])[0-9]{1,5},? (?:(?:[A-Z][\w'-]{1,20} ){1,3}(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Square)\b"
    r"|(?:rue|avenue|boulevard|place) (?:d[eu] |des |de la )?[A-Z][\w'-]{1,20})")
STREET = re.compile(r"(?:\b[A-Z]\w{2,20}(?:straße|strasse|weg|platz)|\b(?:[Cc]alle|[Aa]venida|[Pp]laza) (?:de(?: la)? )?[A-Z]\w{1,20},?) [0-9]{1,5}\b")
NAME = re.compile(
    r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra|Señora?|Monsieur|Madame)\.? [A-ZÀ-ÖØ-Þ][\w'-]{1,20}(?: [A-ZÀ-ÖØ-Þ][\w'-]{1,20})?")
TITLES = ("Mr", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Sr", "Señor", "Monsieur", "Madame")

# Gazetteers: common top-level domains; countries with account numbers and their lengths;
# first digits of payment cards.
TOP_LEVEL = set("com org net edu gov mil int info biz io co uk de fr es it pt nl be ch at pl se no dk fi ie eu us ca au nz jp cn in br mx ar cl ru za".split())
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22,
    "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24,
}
CARD_STARTS = re.compile("4|5[1-5]|2[2-7]|3[47]|6")
CALLING_CODES = re.compile(r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])")
CUES = re.compile(
    r"\b(?:tel|phone|telephone|call|fax|mobile|mail|e-mail|email|contact|card|visa|mastercard|iban|account"
    r"|ssn|social|security|address|telefon|anruf|konto|karte|kontakt|tarjeta|cuenta|correo|contacto"
    r"|tel[eé]fono|carte|compte|courriel|t[eé]l[eé]phone)\b", re.I)
COUNTER_CUES = re.compile(
    r"(?:\b(?:version|release|section|page|pages|isbn|issn|doi|vol|volume|no|nr|order|article|fig|figure|table|chapter)\b"
    r"\.?|[$€£#%=])\s*$", re.I)
SECRET_STARTS = re.compile(r"AKIA[0-9A-Z]{16}$|gh[pousr]_|github_pat_|xox[abprs]-|[sr]k_(?:live|test)_|eyJ[A-Za-z0-9_-]{10}|AIza|glpat-|npm_|ya29")
SECRET_CUES = re.compile(
    r"\b(?:[a-z0-9]+[_-])*(?:token|secret|password|passwd|pwd|passphrase|api[_ -]?key|access[_ -]?key|private[_ -]?key|auth"
    r"|authorization|bearer|credentials?)[\"']?(?:\s*(?:[:=]|=>|is)\s*|\s+)[\"']?$", re.I)
SECRET_COUNTER_CUES = re.compile(
    r"(?:\b(?:sha-?[0-9]*|md5|commit|revision|checksum|digest|hash|etag|uuid|id|integrity)\b[\"']?\s*[:=]?\s*[\"']?|https?://\S*|[#@&?])$", re.I)
LABELERS = ("shape", "check", "gazetteer", "cue", "counter_cue", "neighbour")

CANDIDATE = (
    "array<struct<start: int, rank: int, end: int, kind: string, base: boolean, pattern: string>>"
)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from the @ signs,
    so that long runs without one cost nothing."""
    free = 0  # from where a span may start
    at = text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        free = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(s, e, "email") for s, e in emails(text)] if "@" in text else []
    found += [
        (m.start(), m.end(), "ip") for m in IP.finditer(text)
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
    ]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        found += [
            (m.start(), m.end(), "phone") for m in PHONE.finditer(text)
            if 10 <= len(digits_of(m[0])) <= 15
        ]
    return found


def loose_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Candidates of the other kinds, of which none overlaps a base span or another."""
    found = []
    if "at]" in text or "at)" in text:
        found += [(m.start(), m.end(), "mail") for m in MAIL.finditer(text)]
    for kind, pattern in (
        ("iban", IBAN), ("ssn", SSN), ("local_phone", LOCAL_PHONE), ("account", ACCOUNT), ("address", ADDRESS),
        ("address", STREET), ("secret", SECRET),
    ):
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    if any(t in text for t in TITLES):
        found += [(m.start(), m.end(), "name") for m in NAME.finditer(text)]
    # Base spans by start, and how far those up to each reach.
    starts = [s for s, _, _ in taken]
    reach = list(accumulate((e for _, e, _ in taken), max))
    out, last = [], 0
    for s, e, kind in sorted(found, key=lambda x: (x[0], KINDS.index(x[2]))):
        before = bisect_left(starts, e)
        if s >= last and (not before or reach[before - 1] <= s):
            out.append((s, e, kind))
            last = e
    return out


def iban_valid(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def entropy(s: str) -> float:
    """Bits of a character of s, by its own counts."""
    counts = Counter(s)
    return -sum(n / len(s) * log2(n / len(s)) for n in counts.values())


def votes(text: str, start: int, end: int, kind: str, supported: bool) -> tuple[int, ...]:
    """A vote of each of LABELERS: 1 personal data, -1 not, 0 no vote."""
    span, before = text[start:end], text[max(0, start - AROUND):start]
    after = text[end:end + AROUND]
    glued = (before[-1:].isalnum() and span[0].isalnum()) or (after[:1].isalnum() and span[-1].isalnum())
    d = digits_of(span)
    check = gazetteer = 0
    if kind in ("email", "mail"):
        top = re.split(r"[^A-Za-z0-9-]+", span.strip("])"))[-1].lower()
        gazetteer = 1 if top in TOP_LEVEL else -1
        check = 0 if kind == "email" else -1 if ".." in span else 1
    elif kind == "ip":
        check, gazetteer = 1, -1 if span.startswith("0") else 0
    elif kind == "card":
        check, gazetteer = 1, 1 if CARD_STARTS.match(d) else -1
    elif kind == "phone":
        gazetteer = 1 if CALLING_CODES.match(span) else -1
        check = 1 if len(set(d)) > 2 else -1
    elif kind == "local_phone":
        check = 1 if len(d) == 10 and d[0] in "23456789" and d[3] in "23456789" else -1
    elif kind == "iban":
        country = IBAN_LENGTHS.get(span[:2])
        gazetteer = -1 if country is None else 1 if country == len(span.replace(" ", "")) else -1
        check = 1 if iban_valid(span) else -1
    elif kind == "ssn":
        check = -1 if d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000" else 1
    elif kind == "secret":
        # Words joined by marks repeat letters less evenly than random characters do.
        check = 1 if entropy(span) >= 3 and len(d) * 8 >= len(span) else -1
        gazetteer = 1 if SECRET_STARTS.match(span) else 0
    elif kind == "account":
        check = 1 if len(set(d)) > 4 else -1
        gazetteer = 1 if len(d) == 16 and CARD_STARTS.match(d) else 0
    elif kind == "name":
        check = -1 if span.isupper() else 0
    if kind == "secret":
        cue, counter_cue = SECRET_CUES.search(before), SECRET_COUNTER_CUES.search(before)
    else:
        cue, counter_cue = CUES.search(before) or CUES.match(after.lstrip()), COUNTER_CUES.search(before)
    return (
        -1 if glued else 1, check, gazetteer, 1 if cue else 0, -1 if counter_cue else 0, 1 if supported else 0,
    )


def find(text: str) -> list[dict]:
    """Candidates of a text with their votes, as one pattern each: kind and votes."""
    base = sorted(base_spans(text))
    starts, out = [s for s, _, _ in base], []
    for s, e, kind in [*base, *loose_spans(text, base)]:
        is_base = kind in BASE
        near = bisect_right(starts, e + NEAR) - bisect_left(starts, s - NEAR) > is_base
        v = votes(text, s, e, kind, near)
        out.append({"start": s, "rank": KINDS.index(kind), "end": e, "kind": kind, "base": is_base,
                    "pattern": kind + "".join("-0+"[x + 1] for x in v)})
    return sorted(out, key=lambda c: (c["start"], c["rank"], c["end"]))


def candidates(docs: DataFrame, keep: list[str], column: str) -> DataFrame:
    """The keep columns of each row and its candidates."""
    carried = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").alias(free_name(keep, "_text"))
    )
    found = T.StructType.fromDDL(f"{free_name(keep, '_found')} {CANDIDATE}")
    schema = T.StructType([*carried.schema[:-1], *found])
    arrow = pa.list_(pa.struct([
        ("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32()), ("kind", pa.string()),
        ("base", pa.bool_()), ("pattern", pa.string()),
    ]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in small_batches(batch, batch.num_columns - 1):
                found = [find(t) if t else [] for t in some.column(some.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:-1], pa.array(found, arrow)], schema.names
                )

    return map_arrow(carried, run, schema)


@dataclass
class Model:
    reliabilities: dict[str, tuple[float, float]]  # share of right votes among yes and no votes
    accepted: list[str]  # patterns that are personal data
    spans: dict[str, tuple[int, int]] = field(default_factory=dict)  # of each added kind: accepted, rejected


def expectation_maximisation(v: np.ndarray, n: np.ndarray, steps: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(probability that each pattern is personal data, P(vote | class) of each labeler).

    v: votes (patterns, labelers); n: how often each pattern was seen. Labelers are taken
    to err apart from each other; a prior holds that they are more often right than wrong.
    """
    prior = np.array([[4.0, 2.0, 1.0], [1.0, 2.0, 4.0]])  # of votes -1, 0, 1 by class
    one_hot = (v[:, :, None] == np.array([-1, 0, 1])).astype(float)
    p = 1 / (1 + np.exp(-v.sum(1)))
    for _ in range(steps):
        q = np.stack([1 - p, p])  # class, pattern
        seen = np.einsum("cp,plv->lcv", q * n, one_hot) + prior
        given = seen / seen.sum(2, keepdims=True)
        share = np.clip((q * n).sum(1) + 1, 1, None)
        log = np.log(share / share.sum())[:, None] + np.einsum("plv,lcv->cp", one_hot, np.log(given))
        p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return p, given


def features(kinds: list[str], v: np.ndarray) -> np.ndarray:
    return np.concatenate(
        [np.ones((len(kinds), 1)), v > 0, v < 0, np.array([[k == x for x in KINDS] for k in kinds], float).reshape(-1, len(KINDS))],
        axis=1,
    ).astype(float)


def fit(x: np.ndarray, p: np.ndarray, n: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights of a logistic classifier of soft labels p that were seen n times."""
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    n = n / max(n.mean(), 1e-9)
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (q - p)) + 0.1 * w
        hessian = (x.T * (n * q * (1 - q))) @ x + 0.1 * ridge
        w = w - np.linalg.solve(hessian, gradient)
    return w


def train(found: DataFrame) -> Model:
    """From the candidates of all rows. Without any, nothing is accepted."""
    last = F.col(found.columns[-1])
    counted = found.select(F.explode(last["pattern"]).alias("pattern")).groupBy("pattern").count()
    rows = sorted(tuple(r) for r in counted.collect())  # at most kinds x 3^labelers
    if not rows:
        return Model({}, [])
    split = len(LABELERS)
    kinds = [r[0][:-split] for r in rows]
    v = np.array([["-0+".index(c) - 1 for c in r[0][-split:]] for r in rows])
    n = np.array([float(r[1]) for r in rows])
    p, given = expectation_maximisation(v, n)
    x = features(kinds, v)
    q = 1 / (1 + np.exp(-x @ fit(x, p, n)))
    right = {
        name: (float(g[1, 2] / (g[0, 2] + g[1, 2])), float(g[0, 0] / (g[0, 0] + g[1, 0])))
        for name, g in zip(LABELERS, given)
    }
    # A span needs a labeler that speaks for it beyond its mere shape.
    spoken = (v[:, 1:] > 0).any(1)
    yes = spoken & (q >= ACCEPT)
    spans = {
        kind: tuple(int(n[[k == kind and y == wanted for k, y in zip(kinds, yes)]].sum()) for wanted in (True, False))
        for kind in KINDS if kind in kinds and kind not in BASE
    }
    return Model(right, [r[0] for r, y in zip(rows, yes) if y], spans)


def accepted(model: Model, found: Column) -> Column:
    known = F.array(*[F.lit(p) for p in model.accepted]).cast("array<string>")
    return F.filter(found, lambda c: c["base"] | F.array_contains(known, c["pattern"]))


def personal_data(docs: DataFrame, keep: list[str], column: str = "text") -> DataFrame:
    """The keep columns of each document with spans: array of start, rank (place of the
    kind in KINDS), end, kind, base, pattern, by start and then rank, in code points.

    A null text has no spans. A very long text is searched by itself. Repeated rows are searched each; other columns are ignored,
    whatever their names; a kept column named spans gives way. An empty table gives an
    empty result.
    """
    keep = [c for c in keep if c.lower() != "spans"]
    found = staged(candidates(docs, keep, column), "candidates")
    spans = accepted(train(found), F.col(found.columns[-1]))
    return found.select(*[F.col(f"`{c}`") for c in keep], spans.alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["start"], c["end"])), ","
    )


def masked(text: str, accepted: set[str]) -> str:
    out, end = [], 0
    for c in find(text):
        if c["base"] or c["pattern"] in accepted:
            if c["start"] >= end:
                out += [text[end:c["start"]], f"[{c['kind'].upper()}]"]
            end = max(end, c["end"])
    return "".join([*out, text[end:]])


def mask(docs: DataFrame, column: str = "text", length: str = "n_chars") -> DataFrame:
    """docs with every span replaced by its kind in brackets, overlapping ones by the
    first's. Texts without spans stay as they are, nulls stay null; a column named length
    gets the new number of code points of the texts that changed."""
    model = train(staged(candidates(docs, [], column), "candidates"))
    known, names = set(model.accepted), docs.columns
    at, to = names.index(column), names.index(length) if length in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in small_batches(batch, at):
                columns = list(some.columns)
                old = columns[at].to_pylist()
                new = [masked(t, known) if t else t for t in old]
                columns[at] = pa.array(new, columns[at].type)
                if to is not None:
                    columns[to] = pa.array(
                        [n if a == b else len(b) for n, a, b in zip(columns[to].to_pylist(), old, new)],
                        columns[to].type,
                    )
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(docs, run, docs.schema)
