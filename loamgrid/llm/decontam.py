"""Benchmark decontamination by latent semantic retrieval, common subsequences and an answer check.

1. Terms are the benchmark's words.  Their document frequencies are counted over
   all documents.
2. TF-IDF passages of the benchmark, all of them, give a latent space by randomised
   SVD: subspace iteration in which Spark multiplies the passage matrix and only
   term-by-rank matrices return.  The benchmark is what is searched for, so it is
   the indexed collection; every document is folded in, none is drawn to fit on.
3. Every document is cut into overlapping passages of ``2 * HALF`` words.  Those
   with ``SHARE`` of their TF-IDF mass in the benchmark's terms, and whose latent
   cosine with a passage of an item reaches ``COSINE``, are candidates.
4. Items shorter than a passage are searched at their own length as well.  What is
   confirmed holds ``PARAPHRASE`` of the item, so at least one of as many of its
   words as may be missing and one more.  The item's rarest are listed, and every
   place of one in a document is a candidate: the words that then lie where the
   item's would, and a quarter of its length on either side.
5. A candidate is confirmed on the words around it: by a common subsequence that
   covers ``COPY`` of the item, or ``PARAPHRASE`` of it if it also has ``ANSWER``
   of the item's closing words, where its answer stands.

The benchmark is the stated query set: it goes to every task, and a larger one
than ``LIMIT`` words is refused, to be run in parts.

Defined cases: null text counts as empty, null or empty items are no items, an
empty benchmark contaminates nothing, repeated items count once per id, an
item of one to three words is found wherever all of them stand in a row, words of
punctuation alone don't count in the search at an item's own length, repeated
rows give repeated rows, null ids pass through, further columns are kept where
rows are filtered and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, store

HALF = 8
COSINE, SHARE = 0.65, 0.5
COPY, PARAPHRASE, ANSWER = 0.75, 0.6, 0.8
RANK, EXTRA = 64, 16
LIMIT = 5_000_000


def tidy(word: str) -> str:
    return word.lower().strip("\"'.,;:!?()[]{}<>*&%$#@|/\\+=~`^_-")


class Terms(dict):
    """Raw word to term number; words outside the benchmark share the last number, those of punctuation alone are -1."""

    def __init__(self, terms: list[str]) -> None:
        super().__init__()
        self.known = {t: i for i, t in enumerate(terms)}

    def __missing__(self, word: str) -> int:
        plain = tidy(word)
        value = self.known.get(plain, len(self.known)) if plain else -1
        if len(self) < 300_000:
            self[word] = value
        return value


def common_subsequence(item: list[int], stretch: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    state = full = (1 << len(item)) - 1
    for w in stretch.tolist():
        m = masks.get(w)
        if m:
            u = state & m
            state = ((state + u) | (state - u)) & full
    return len(item) - state.bit_count()


def confirmed(item: list[int], stretch: np.ndarray) -> float:
    """Share of the item found in the stretch, 0 if that isn't enough."""
    share = common_subsequence(item, stretch) / len(item)
    if share < PARAPHRASE:
        return 0.0
    tail = item[-max(4, len(item) // 4):]
    return share if share >= COPY or common_subsequence(tail, stretch) >= ANSWER * len(tail) else 0.0


def cut(words: list) -> list[list]:
    """Overlapping passages of 2 * HALF words, the last flush with the end."""
    last = max(0, len(words) - 2 * HALF)
    return [words[a:a + 2 * HALF] for a in [*range(0, last, HALF), last]]


@dataclass
class Searcher:
    terms: list[str]
    items: list[tuple[int, list[int]]]
    idf: np.ndarray         # of the terms, and last of any other word
    space: np.ndarray       # (terms + 1) x rank: idf-weighted loadings, zero for other words
    passages: np.ndarray    # unit vectors of item passages
    owner: np.ndarray       # item of each passage
    listed: dict[int, list[tuple[int, int]]] = field(default_factory=dict)  # term to (item, place in it), of items shorter than a passage

    def short_matches(self, rows: list[np.ndarray]) -> dict[tuple[int, int], float]:
        """(text, item) to share found, for items shorter than a passage; rows are the texts' terms without punctuation."""
        best: dict[tuple[int, int], float] = {}
        if not self.listed or not rows:
            return best
        blank, pad = len(self.terms), 4 * HALF
        gap = np.full(pad, blank, dtype=np.int32)
        row = np.concatenate([gap, *(part for r in rows for part in (r, gap))])
        doc = np.repeat(np.arange(len(rows)), [len(r) + pad for r in rows])
        flag = np.zeros(blank + 1, dtype=bool)
        flag[list(self.listed)] = True
        at = np.flatnonzero(flag[row])
        if not len(at):
            return best
        at = at[np.argsort(row[at], kind="stable")]
        terms, first = np.unique(row[at], return_index=True)
        for term, places in zip(terms.tolist(), np.split(at, first[1:]), strict=True):
            for o, j in self.listed[term]:
                item = self.items[o][1]
                slack = len(item) // 4
                bag = np.zeros(blank + 1, dtype=bool)
                bag[item] = True
                for a in range(0, len(places), 65536):
                    start = places[a:a + 65536] - j - slack
                    stretches = row[start[:, None] + np.arange(len(item) + 2 * slack)]
                    for i in np.flatnonzero(bag[stretches].sum(1) >= PARAPHRASE * len(item)).tolist():
                        share = confirmed(item, stretches[i])
                        key = (int(doc[places[a + i] - pad]), o)
                        if share > best.get(key, 0.0):
                            best[key] = share
        return best

    def matches(self, texts: list[str], terms: Terms) -> list[list[tuple[int, float]]]:
        """Per text the (item id, share of the item found), confirmed ones only."""
        blank = len(self.terms)
        rows = [np.fromiter(map(terms.__getitem__, words), dtype=np.int32, count=len(words)) for words in map(str.split, texts)]
        best = self.short_matches([r[r >= 0] for r in rows])
        rows = [np.where(r < 0, blank, r) for r in rows]
        sizes = [len(r) for r in rows]
        # each text fills whole halves, followed by one blank half that keeps passages within it
        halves_of = np.array([-(-n // HALF) + 1 for n in sizes], dtype=np.int64)
        first = np.cumsum(halves_of) - halves_of
        row = np.full(int(halves_of.sum()) * HALF, blank, dtype=np.int32)
        real = np.zeros(len(row), dtype=bool)
        for at, r in zip((first * HALF).tolist(), rows, strict=True):
            row[at:at + len(r)] = r
            real[at:at + len(r)] = True
        out: list[list[tuple[int, float]]] = [[] for _ in texts]
        # passages of which the benchmark's terms explain too little can't hold an item
        mass = np.where(real, (self.idf * self.idf)[row], 0.0)
        inside = np.where(row < blank, mass, 0.0).reshape(-1, HALF).sum(1)
        mass = mass.reshape(-1, HALF).sum(1)
        rich = np.flatnonzero((inside[:-1] + inside[1:] >= SHARE * (mass[:-1] + mass[1:])) & (inside[:-1] > 0))
        found: dict[tuple[int, int], list[int]] = {}
        starts, halves = first, row.reshape(-1, HALF)
        for a in range(0, len(rich), 1024):
            at = rich[a:a + 1024]
            window = self.space[np.concatenate((halves[at], halves[at + 1]), axis=1)].sum(1)
            window /= np.maximum(np.sqrt((window * window).sum(1)), 1e-9)[:, None]
            w, p = np.nonzero(window @ self.passages.T >= COSINE)
            doc = np.searchsorted(starts, at[w], side="right") - 1
            for d, x, o in zip(doc.tolist(), at[w].tolist(), self.owner[p].tolist(), strict=True):
                found.setdefault((d, o), []).append(x)
        for (d, o), places in found.items():
            item = self.items[o][1]
            base, bag = int(first[d]) * HALF, set(item)
            for x in dict.fromkeys(places):
                lo = max(base, x * HALF - len(item))
                stretch = row[lo:min(base + sizes[d], (x + 2) * HALF + len(item))]
                if len(bag.intersection(stretch.tolist())) < PARAPHRASE * len(bag) / 2:
                    continue
                share = confirmed(item, stretch)
                if share > best.get((d, o), 0.0):
                    best[d, o] = share
        for (d, o), share in best.items():
            out[d].append((self.items[o][0], share))
        return [sorted(m) for m in out]


def _latent(rows: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Right singular vectors of the passage matrix: terms x rank, by randomised subspace iteration."""
    n, width = len(idf), min(RANK + EXTRA, len(idf))

    def product(basis: np.ndarray, gram: bool) -> np.ndarray:
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width, width) if gram else (n, width))
            for batch in parts:
                for ids in batch.column(0).to_pylist():
                    if ids:
                        at, tf = np.unique(ids, return_counts=True)
                        x = tf * idf[at]
                        x = x / max(np.sqrt((x * x).sum()), 1e-12)
                        y = x @ basis[at]
                        if gram:
                            total += np.outer(y, y)
                        else:
                            total[at] += np.outer(x, y)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

        total = np.zeros((width, width) if gram else (n, width))
        for r in rows.mapInArrow(run, "m binary").toLocalIterator():  # one matrix of fixed size per task
            total += np.frombuffer(bytes(r["m"])).reshape(total.shape)
        return total

    basis = np.linalg.qr(np.random.default_rng(17).standard_normal((n, width)))[0]
    for _ in range(2):
        basis = np.linalg.qr(product(basis, False))[0]
    value, vector = np.linalg.eigh(product(basis, True))
    return basis @ vector[:, np.argsort(-value)[:RANK]]


def searcher(docs: DataFrame, benchmark: DataFrame) -> Searcher:
    texts = docs.select(F.col("text").cast("string"))
    raw = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null and text is not null")
    if (raw.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0) > LIMIT:
        raise ValueError(f"more than {LIMIT} words of benchmark; search it in parts")
    worded = [(r["item_id"], [t for w in r["text"].split() if (t := tidy(w))]) for r in raw.dropDuplicates().orderBy("item_id", "text").collect()]
    worded = [(i, w) for i, w in worded if w]
    terms = sorted({t for _, w in worded for t in w})
    number = {t: i for i, t in enumerate(terms)}
    items = [(i, [number[t] for t in w]) for i, w in worded]
    if not items:
        return Searcher([], [], np.ones(1), np.zeros((1, 1), dtype=np.float32), np.zeros((0, 1), dtype=np.float32), np.empty(0, dtype=np.int64))

    def frequencies(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, df, n = Terms(terms), np.zeros(len(terms) + 1, dtype=np.int64), 0
        for batch in batches(rows):
            n += batch.num_rows
            for text in batch.column(0).to_pylist():
                if text:
                    df[np.fromiter(set(map(ids.__getitem__, text.split())), dtype=np.int64)] += 1
        df[-1] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df))), pa.array(df)], ["term", "n"])

    df = np.zeros(len(terms) + 1)
    for r in texts.mapInArrow(frequencies, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]
    documents = df[-1]
    idf = np.log((documents + 1) / (df[:-1] + 1)) + 0.01

    own = [p for _, w in items for p in cut(w)]
    rows = store(docs.sparkSession.createDataFrame([(p,) for p in own], "ids array<bigint>").repartition(12))
    space = np.vstack((idf[:, None] * _latent(rows, idf), np.zeros((1, min(RANK, len(terms)))))).astype(np.float32)
    vectors = np.array([space[p].sum(0) for p in own])
    length = np.sqrt((vectors * vectors).sum(1))
    owner = np.array([o for o, (_, w) in enumerate(items) for _ in cut(w)])
    good = length > 1e-9
    listed: dict[int, list[tuple[int, int]]] = {}
    for o, (_, w) in enumerate(items):
        if len(w) < 2 * HALF:
            spare = len(w) - int(np.ceil(PARAPHRASE * len(w) - 1e-9))
            for j in sorted(range(len(w)), key=lambda j: (-idf[w[j]], j))[:spare + 1]:
                listed.setdefault(w[j], []).append((o, j))
    return Searcher(
        terms, items, np.append(idf, idf.mean()), space, (vectors[good] / length[good][:, None]).astype(np.float32), owner[good], listed)


def contaminated(docs: DataFrame, found: Searcher) -> DataFrame:
    """doc_id, contaminated, n_items, items (ids of the benchmark's items found), best (largest share of an item found)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(found.terms)
        for batch in batches(rows, 1 << 20):
            hits = found.matches([t or "" for t in batch.column(1).to_pylist()], terms)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([bool(h) for h in hits]), pa.array([len(h) for h in hits], pa.int64()),
                 pa.array([[i for i, _ in h] for h in hits], pa.list_(pa.int64())),
                 pa.array([max((s for _, s in h), default=0.0) for h in hits], pa.float64())],
                ["doc_id", "contaminated", "n_items", "items", "best"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, contaminated boolean, n_items bigint, items array<bigint>, best double")


def keep_clean(docs: DataFrame, found: Searcher) -> DataFrame:
    """The rows of ``docs`` in which no item was found."""
    place = docs.columns.index("text")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(found.terms)
        for batch in batches(rows, 1 << 20):
            hits = found.matches([t or "" for t in batch.column(place).to_pylist()], terms)
            yield batch.filter(pa.array([not h for h in hits], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
