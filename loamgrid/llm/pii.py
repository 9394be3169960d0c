"""Personal data: weak labelers vote on candidate spans, expectation-maximisation weighs them, a span classifier decides.

1. Candidates are found in every whole text: everything the strict patterns
   accept (these spans always stay), what they nearly accept, telephone numbers
   without a plus sign and credentials.
2. Four labelers vote +1, 0 or -1 on a candidate: the strict pattern, a
   gazetteer, the context and the shape.  Only the signature of a candidate
   (kind, votes, coarse features) matters from here on, and there is a fixed
   number of possible signatures, so Spark counts them over all documents and
   the models are fitted on the counts.
3. Expectation-maximisation estimates each labeler's reliability per kind
   without labels.  Its posteriors train a logistic regression over votes and
   features, which accepts or rejects candidates beyond the strict ones.

Defined cases: null text counts as empty; a null id is passed through; repeated
rows give repeated rows; an empty table trains nothing and accepts strict spans
only; further columns are not looked at.  Offsets are code points, end exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, store

KINDS = ("email", "ip", "card", "phone", "secret")
STRICT = KINDS[:4]
VOTERS = 4

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive, and never begun within a run of digits: the same matches in linear time
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_SECRET = re.compile(r"(?:(?<![A-Za-z])([A-Za-z_-]{3,20})\x20?[=:]\x20?\"?([A-Za-z0-9+/_-]{8,})\"?)|(AKIA[0-9A-Z]{16})")

# A gazetteer per kind, and cue words per kind.
ENDINGS = frozenset("com org net edu gov io de fr es uk eu info example".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49",
                 "52", "54", "55", "61", "81", "82", "86", "91")
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
KEY_NAMES = frozenset("password passwd pwd token secret api_key apikey api-key access_key auth".split())
CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel"), "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"), "phone": ("phone", "tel", "call", "fax", "telefon", "mobile"),
    "secret": ("key", "login", "credential", "secret", "password"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


_IN_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards: linear however long a word is."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _IN_LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, strict), strict ones as the base patterns match them."""
    out = [("email", a, b, True) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        out.append(("ip", *m.span(), all(len(d) <= 3 and int(d or 0) <= 255 for d in (p.lstrip("0") for p in m[0].split(".")))))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19:
                out.append(("card", *m.span(), luhn(digits)))
    if "+" in text:
        for m in _PHONE.finditer(text):
            n = sum(c.isdigit() for c in m[0])
            if 7 <= n <= 18:
                out.append(("phone", *m.span(), 9 <= n <= 15))
    out += [("phone", *m.span(), False) for m in _LOOSE_PHONE.finditer(text)]
    if "=" in text or ":" in text or "AKIA" in text:
        out += [("secret", *(m.span(3) if m[3] else m.span(2)), False) for m in _SECRET.finditer(text)]
    return out


def _votes(text: str, kind: str, start: int, end: int, strict: bool) -> tuple[int, ...]:
    span, before, after = text[start:end], text[max(0, start - 24):start], text[end:end + 1]
    bare = "".join(c for c in span if c.isdigit())
    if kind == "email":
        named = 1 if span.rpartition(".")[2].lower() in ENDINGS else -1
        shape = 1 if 6 <= len(span) <= 64 else -1
    elif kind == "ip":
        first = span.partition(".")[0]
        named = 0 if first in ("10", "127", "192", "172") else -1 if first.startswith("0") else 1
        shape = 1 if len(span) <= 15 else -1
    elif kind == "card":
        named = 1 if bare.startswith(ISSUERS) else -1
        shape = 1 if len(bare) in (15, 16) else -1 if len(set(bare)) < 4 else 0
    elif kind == "phone":
        named = (1 if bare.startswith(CALLING_CODES) else -1) if span[0] == "+" else 0
        shape = 1 if 9 <= len(bare) <= 13 else -1
    else:
        key = re.split(r"[^A-Za-z_-]", before.rstrip(' ="\':'))[-1].lower()
        named = 1 if span.startswith("AKIA") or key in KEY_NAMES else -1
        shape = 1 if bare and len(bare) < len(span) and len(set(span)) > 6 else -1
    touching = (before[-1:].isalnum() and kind != "secret") or after.isalnum()
    context = -1 if touching else int(any(cue in before.lower() for cue in CUES[kind]))
    exact = 1 if strict else (0 if kind in ("secret", "phone") else -1)
    return exact, named, context, shape


def _side(c: str) -> str:
    return "w" if c.isalnum() else "s" if not c or c.isspace() else "p"


def find(text: str) -> list[tuple[str, int, int, bool, str]]:
    """(kind, start, end, strict, signature) by start, then kind.

    Candidates that aren't strict give way to strict ones and to earlier ones.
    """
    raw = _candidates(text)
    if not raw:
        return []
    kept, free = [], 0
    strict = sorted((c for c in raw if c[3]), key=lambda c: c[1])
    starts, ends = [c[1] for c in strict], list(accumulate((c[2] for c in strict), max))
    for c in sorted((c for c in raw if not c[3]), key=lambda c: (c[1], -c[2], KINDS.index(c[0]))):
        if c[1] >= free and not _overlaps(starts, ends, c[1], c[2]):
            kept.append(c)
            free = c[2]
    out = []
    for kind, a, b, s in strict + kept:
        marks = _votes(text, kind, a, b, s)
        size = min(3, (b - a) // 8)
        out.append((kind, a, b, s, f"{kind}|{'|'.join(map(str, marks))}|{size}|{_side(text[a - 1:a] if a else '')}{_side(text[b:b + 1])}"))
    return sorted(out, key=lambda c: (c[1], KINDS.index(c[0]), c[2]))


def _overlaps(starts: list[int], ends: list[int], start: int, end: int) -> bool:
    """Whether a span by rising start, given with the largest end so far, overlaps this one."""
    at = bisect.bisect_left(starts, end)
    return at > 0 and ends[at - 1] > start


_SCANNED = pa.schema([
    ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in STRICT], ("base_sha256", pa.string()),
    ("found", pa.list_(pa.struct([("span", pa.string()), ("strict", pa.bool_()), ("sig", pa.string())]))),
])


def _scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        columns: list[list] = [[] for _ in _SCANNED]
        for text in batch.column(1).to_pylist():
            found = find(text or "")
            for i, kind in enumerate(STRICT):
                columns[1 + i].append(sum(f[3] and f[0] == kind for f in found))
            base = ",".join(f"{k}:{a}:{b}" for k, a, b, strict, _ in found if strict)
            columns[5].append(hashlib.sha256(base.encode()).hexdigest())
            columns[6].append([{"span": f"{k}:{a}:{b}", "strict": s, "sig": sig} for k, a, b, s, sig in found])
        arrays = [batch.column(0), *[pa.array(c, f.type) for c, f in zip(columns[1:], list(_SCANNED)[1:], strict=True)]]
        yield pa.RecordBatch.from_arrays(arrays, schema=_SCANNED)


@dataclass(frozen=True)
class SpanModel:
    """reliability: per kind, P(vote | truth) as [truth][voter][vote + 1]; accept: signatures taken as personal data."""

    reliability: dict[str, np.ndarray]
    prior: dict[str, float]
    chance: dict[str, float]
    threshold: float = 0.5

    @property
    def accept(self) -> list[str]:
        return sorted(s for s, p in self.chance.items() if p >= self.threshold)


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, float, np.ndarray]:
    """Expectation-maximisation over vote patterns: reliabilities, prior, posterior per pattern."""
    post = np.clip(0.5 + votes.sum(1) / (2.0 * VOTERS + 2), 0.05, 0.95)
    table, prior = np.zeros((2, VOTERS, 3)), 0.5
    for _ in range(rounds):
        for truth, weight in ((1, counts * post), (0, counts * (1 - post))):
            for v in range(VOTERS):
                tally = np.bincount(votes[:, v] + 1, weights=weight, minlength=3) + 0.5
                table[truth, v] = tally / tally.sum()
        prior = float(np.clip((counts * post).sum() / counts.sum(), 0.01, 0.99))
        odds = np.full(len(votes), np.log(prior / (1 - prior)))
        for v in range(VOTERS):
            odds += np.log(table[1, v, votes[:, v] + 1] / table[0, v, votes[:, v] + 1])
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return table, prior, post


def _features(sigs: list[str]) -> tuple[np.ndarray, dict[str, int]]:
    names: dict[str, int] = {}
    rows = [[names.setdefault(f"{i}:{p}", len(names)) for i, p in enumerate(s.split("|"))] for s in sigs]
    x = np.zeros((len(sigs), len(names) + 1))
    x[:, -1] = 1
    for r, cols in enumerate(rows):
        x[r, cols] = 1
    return x, names


def train(scanned: DataFrame, threshold: float = 0.5) -> SpanModel:
    """Fit on the counts of signatures over all documents (at most a few thousand different ones)."""
    counts = scanned.select(F.explode("found.sig").alias("sig")).groupBy("sig").count().orderBy("sig").collect()
    sigs, n = [r["sig"] for r in counts], np.array([r["count"] for r in counts], dtype=float)
    reliability, priors, post = {}, {}, np.zeros(len(sigs))
    for kind in KINDS:
        at = [i for i, s in enumerate(sigs) if s.startswith(f"{kind}|")]
        if at:
            votes = np.array([[int(v) for v in sigs[i].split("|")[1:1 + VOTERS]] for i in at])
            reliability[kind], priors[kind], post[at] = estimate(votes, n[at])
    if not sigs:
        return SpanModel({}, {}, {}, threshold)
    x, _ = _features(sigs)
    w, ridge = np.zeros(x.shape[1]), 1e-2
    weight = n / n.sum()
    for _ in range(50):  # Newton steps on the posterior-weighted likelihood
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (post - p)) - ridge * w / len(sigs)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)) / len(sigs) + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return SpanModel(reliability, priors, dict(zip(sigs, p.tolist(), strict=True)), threshold)


def scan(docs: DataFrame) -> DataFrame:
    fields = ", ".join(["doc_id bigint", *[f"n_{k} bigint" for k in STRICT], "base_sha256 string",
                        "found array<struct<span: string, strict: boolean, sig: string>>"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_scan, fields)


def _accepted(model: SpanModel) -> Column:
    taken = F.array(*[F.lit(s) for s in model.accept]).cast("array<string>")
    return F.filter("found", lambda f: f["strict"] | F.array_contains(taken, f["sig"]))


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: strict counts and digest, all spans, and how many the method added."""
    scanned = store(scan(docs))
    model = train(scanned)
    taken = scanned.withColumn("taken", _accepted(model))
    return taken.select(
        "doc_id", *[f"n_{k}" for k in STRICT], "base_sha256",
        F.array_join(F.transform("taken", lambda f: f["span"]), ",").alias("spans"),
        F.size(F.filter("taken", lambda f: ~f["strict"])).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets; ``n_chars`` follows where it exists."""
    accept = frozenset(train(store(scan(docs).select("found"))).accept)
    place, schema = docs.columns.index("text"), docs.schema

    def clean(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            texts = []
            for text in batch.column(place).to_pylist():
                spans = [f for f in find(text or "") if f[3] or f[4] in accept]
                if spans:
                    parts, at = [], 0
                    for kind, a, b, _, _ in spans:
                        if b > at:
                            parts += [text[at:max(a, at)], f"<{kind.upper()}>"] if a >= at else []
                            at = b
                    text = "".join([*parts, text[at:]])
                texts.append(text)
            arrays = list(batch.columns)
            arrays[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    out = docs.mapInArrow(clean, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
