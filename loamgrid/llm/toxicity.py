"""Toxicity: a linear-chain conditional random field tags tokens, its marginals make document scores.

Labels are per document.  Token labels come from them: in a sample of labelled
documents, words and word beginnings that occur (nearly) only in toxic ones mark
tokens of toxic documents as toxic.  The field has two states; a token's emission
sums weights of its word and of its first 4, 5 and 6 letters, transitions carry
the state along the whole text, however long.  Forward-backward marginals of all tokens give the
document's features, and a logistic regression on those, weighted back to the
true share of labels, gives the score.

Only fitting is bounded: ``sample`` documents of each label, chosen by a hash of
the id among all labelled ones, and ``windows`` stretches of ``SPAN`` tokens of
each kind.  Scoring reads every whole text.

Defined cases: null text counts as empty; an empty text has the features of no
toxic token and so the base score; a label that is neither 0 nor 1, or without
an id, teaches nothing; of several labels of one id the largest counts; without
labels of both kinds the score is the share of label 1 (0 without any label);
repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, remainder, store

THRESHOLD = 0.3
SPAN = 24       # tokens of a training window
SEGMENT = 64    # tokens of a chain passed over at once; what enters and leaves it comes from its whole text
_TOKEN = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    """The words of the text as it is, each in lower case."""
    return [w.lower() for w in _TOKEN.findall(text)]


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n)]


def chain(
    emission: np.ndarray, mask: np.ndarray, transition: np.ndarray, enter: np.ndarray | float = 1.0, leave: np.ndarray | float = 1.0,
) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over rows of tokens: P(toxic) per token, expected transitions, log-likelihood's normaliser.

    ``emission`` is the log-odds of the toxic state; ``mask`` is true for a prefix of each row.
    ``enter`` and ``leave`` weigh the states of a row's first and last token by what precedes and follows it.
    """
    n, width = emission.shape
    top = np.maximum(emission, 0)
    potential = np.stack((np.exp(-top), np.exp(emission - top)), axis=2)
    step = np.exp(transition)
    forward, scale = np.empty((n, width, 2)), np.ones((n, width))
    a = potential[:, 0] * enter
    for t in range(width):
        if t:
            a = (a @ step) * potential[:, t]
        s = a.sum(1)
        a = a / s[:, None]
        forward[:, t], scale[:, t] = a, s
    norm = float(((np.log(scale) + top) * mask).sum())
    leave = np.broadcast_to(leave, (n, 2))
    backward = leave
    p = np.empty((n, width))
    pairs = np.zeros((2, 2))
    for t in range(width - 1, -1, -1):
        both = forward[:, t] * backward
        p[:, t] = both[:, 1] / both.sum(1)
        if t:
            out = potential[:, t] * backward
            live = mask[:, t]
            joint = forward[live, t - 1][:, :, None] * step * out[live][:, None, :]
            pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
            backward = np.where(live[:, None], out @ step.T, leave)
            backward = backward / backward.sum(1, keepdims=True)
    return p, pairs, norm


def borders(emission: np.ndarray, mask: np.ndarray, transition: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What enters and leaves each row of tokens, where rows ``first[i]`` to ``first[i] + count[i]`` make one text.

    Each row's two-by-two product of transitions and potentials carries the states of its
    first token to its last; the products of a text, in order, give the messages at all
    borders, so marginals are those of the undivided chain.
    """
    n, width = emission.shape
    enter, leave = np.ones((n, 2)), np.ones((n, 2))
    long = np.flatnonzero(count > 1)
    if not len(long):
        return enter, leave
    step = np.exp(transition)
    rows = np.concatenate([np.arange(f, f + c) for f, c in zip(first[long], count[long], strict=True)])
    e, live = emission[rows], mask[rows]
    top = np.maximum(e, 0)
    potential = np.stack((np.exp(-top), np.exp(e - top)), axis=2)
    m = np.eye(2)[None] * potential[:, 0][:, None, :]
    for t in range(1, width):
        m = np.where(live[:, t][:, None, None], (m @ step) * potential[:, t][:, None, :], m)
        m = m / m.sum((1, 2), keepdims=True)
    through = np.empty((n, 2, 2))
    through[rows] = m
    for j in range(1, int(count.max())):
        at = first[count > j] + j
        out = np.einsum("ni,nij->nj", enter[at - 1], through[at - 1]) @ step
        enter[at] = out / out.sum(1, keepdims=True)
        at = (first + count)[count > j] - j  # from the end: the row after is row ``at``
        out = np.einsum("nij,nj->ni", through[at], leave[at]) @ step.T
        leave[at - 1] = out / out.sum(1, keepdims=True)
    return enter, leave


@dataclass
class Tagger:
    weights: dict[str, float]
    bias: float
    transition: np.ndarray
    calibration: np.ndarray  # of 1, the strongest marginal, log(1 + expected toxic tokens)

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def tag(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """P(toxic) of every token of every text, end to end, and the texts' token counts."""
        memo = _Memo(self)
        values: list[float] = []
        sizes = []
        for text in texts:
            words = tokens(text)
            sizes.append(len(words))
            values.extend(map(memo.__getitem__, words))
        emission, sizes = np.array(values), np.array(sizes, dtype=np.int64)
        if not len(emission):
            return emission, sizes
        ends = np.cumsum(sizes)
        starts = np.concatenate([np.arange(b - n, b, SEGMENT) for b, n in zip(ends, sizes, strict=True) if n])
        stops = np.minimum(starts + SEGMENT, ends[np.searchsorted(ends, starts, side="right")])
        at = starts[:, None] + np.arange(SEGMENT)
        mask = at < stops[:, None]
        grid = np.where(mask, emission[np.minimum(at, len(emission) - 1)], 0.0)
        count = -(-sizes[sizes > 0] // SEGMENT)
        return chain(grid, mask, self.transition, *borders(grid, mask, self.transition, np.cumsum(count) - count, count))[0][mask], sizes

    def describe(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text (1, strongest marginal, log(1 + expected toxic tokens)); all marginals; token counts."""
        p, sizes = self.tag(texts)
        x = np.zeros((len(texts), 3))
        x[:, 0] = 1
        some = np.flatnonzero(sizes)
        if len(some):
            first = (np.cumsum(sizes) - sizes)[some]
            x[some, 1] = np.maximum.reduceat(p, first)
            x[some, 2] = np.log1p(np.add.reduceat(p, first))
        return x, p, sizes

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.calibration, -30, 30)))


class _Memo(dict):
    def __init__(self, tagger: Tagger) -> None:
        super().__init__()
        self.tagger = tagger

    def __missing__(self, word: str) -> float:
        value = self.tagger.emission(word)
        if len(self) < 300_000:
            self[word] = value
        return value


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_field(windows: list[tuple[list[str], list[int]]], rounds: int = 60, ridge: float = 0.02) -> tuple[dict[str, float], float, np.ndarray]:
    """Maximum likelihood of the token labels by gradient ascent (Adam)."""
    counts = Counter(f for words, _ in windows for w in words for f in features(w))
    names = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= 3))}
    n, bias_at = len(windows), len(names)
    mask = np.zeros((n, SPAN), dtype=bool)
    gold = np.zeros((n, SPAN))
    rows, cols = [], []
    for r, (words, labels) in enumerate(windows):
        mask[r, :len(words)] = True
        gold[r, :len(words)] = labels
        for t, w in enumerate(words):
            for f in features(w):
                if f in names:
                    rows.append(r * SPAN + t)
                    cols.append(names[f])
    rows, cols = np.array(rows, dtype=np.int64), np.array(cols, dtype=np.int64)
    state = gold.astype(int)
    seen = np.zeros((2, 2))
    np.add.at(seen, (state[:, :-1][mask[:, 1:]], state[:, 1:][mask[:, 1:]]), 1)
    theta = np.zeros(bias_at + 1 + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for it in range(1, rounds + 1):
        flat = np.bincount(rows, weights=theta[cols], minlength=n * SPAN)
        emission = (flat + theta[bias_at]).reshape(n, SPAN)
        p, pairs, _ = chain(np.where(mask, emission, 0.0), mask, theta[bias_at + 1:].reshape(2, 2))
        miss = np.where(mask, gold - p, 0.0)
        grad = np.concatenate((
            np.bincount(cols, weights=miss.ravel()[rows], minlength=bias_at), [miss.sum()], (seen - pairs).ravel()))
        grad -= ridge * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        theta += 0.3 * (m / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-8)
    weights = {f: float(theta[i]) for f, i in names.items() if abs(theta[i]) > 1e-3}
    return weights, float(theta[bias_at]), theta[bias_at + 1:].reshape(2, 2)


def sample_labelled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``sample`` documents of each label by a hash of the id; and how many there are of each."""
    usable = labels.where((remainder(F.col("doc_id"), 4) != 2) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = store(usable.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")))
    totals = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    picks = [usable.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    picked = F.broadcast(picks[0].unionByName(picks[1]))  # at most 2 * sample rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return store(texts.join(picked, "doc_id").select("toxic", "text")), totals


def _document_counts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen[y].update({f for w in set(tokens(text)) for f in features(w)})
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_pydict({"f": names, "clean": [seen[0][f] for f in names], "toxic": [seen[1][f] for f in names]})


def marks(labelled: DataFrame, purity: float = 0.95, least: int = 5) -> set[str]:
    """Words and beginnings that, at equal shares of either label, are at least ``purity`` toxic."""
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return set()
    ratio = sizes[1] / sizes[0]
    counts = labelled.repartition(16).mapInArrow(_document_counts, "f string, clean bigint, toxic bigint").groupBy("f").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    pure = counts.where((F.col("toxic") >= least) & (F.col("toxic") >= purity * (F.col("toxic") + (F.col("clean") + 0.05) * F.lit(ratio))))
    return {r["f"] for r in pure.select("f").collect()}


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = 3000, windows: int = 4000) -> Tagger:
    labelled, totals = sample_labelled(docs, labels, sample)
    lexicon = marks(labelled)
    everything = sum(totals.values())
    share = totals.get(1, 0) / everything if everything else 0.0
    if not lexicon:
        edge = np.clip(share, 1e-9, 1 - 1e-9)
        return Tagger({}, -30.0, np.zeros((2, 2)), np.array([np.log(edge / (1 - edge)), 0.0, 0.0]))

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            out: dict[str, list] = {"kind": [], "words": [], "tags": []}
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = tokens(text)
                for at in range(0, len(words), SPAN):
                    part = words[at:at + SPAN]
                    tags = [int(y == 1 and any(f in lexicon for f in features(w))) for w in part]
                    # every window with a toxic token, and of the others one in eight
                    if any(tags) or (at // SPAN) % 8 == 0:
                        out["kind"].append(max(tags))
                        out["words"].append(part)
                        out["tags"].append(tags)
            yield pa.RecordBatch.from_pydict(
                out, schema=pa.schema([("kind", pa.int32()), ("words", pa.list_(pa.string())), ("tags", pa.list_(pa.int32()))]))

    cuts = store(labelled.repartition(16).mapInArrow(cut, "kind int, words array<string>, tags array<int>"))
    chosen = [cuts.where(F.col("kind") == k).orderBy(F.xxhash64("words"), "words").limit(windows) for k in (0, 1)]
    stretches = [(r["words"], r["tags"]) for part in chosen for r in part.collect()]
    tagger = Tagger(*fit_field(stretches), np.zeros(3))

    def describe(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            x, _, _ = tagger.describe(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({"y": batch.column(0), "a": x[:, 1], "b": x[:, 2]})

    seen = labelled.repartition(16).mapInArrow(describe, "y int, a double, b double").collect()  # at most 2 * sample rows
    y = np.array([r["y"] for r in seen], dtype=float)
    x = np.array([[1.0, r["a"], r["b"]] for r in seen])
    weight = np.where(y == 1, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1)) * len(y)
    tagger.calibration = logistic(x, y, weight)
    return tagger


def _spans(text: str, p: np.ndarray) -> str:
    """start:end of each run of tokens that are toxic rather than not."""
    out: list[list[int]] = []
    last = -2
    for i, m in enumerate(_TOKEN.finditer(text)):
        if p[i] >= 0.5:
            if i == last + 1:
                out[-1][1] = m.end()
            else:
                out.append([*m.span()])
            last = i
    return ",".join(f"{a}:{b}" for a, b in out)


def score(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id, held_out, score, predicted, spans (start:end in code points of the text)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            texts = [t or "" for t in batch.column(2).to_pylist()]
            x, p, sizes = tagger.describe(texts)
            value = tagger.score(x)
            ends = np.cumsum(sizes)
            spans = [_spans(t, p[b - n:b]) if top >= 0.5 else "" for t, b, n, top in zip(texts, ends, sizes, x[:, 1], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32)), pa.array(spans, pa.string())],
                ["doc_id", "held_out", "score", "predicted", "spans"])

    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), "text").mapInArrow(
        run, "doc_id bigint, held_out boolean, score double, predicted int, spans string")
