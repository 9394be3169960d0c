"""Language identification by rank-order n-gram profiles and out-of-place distance.

A profile is a list of the most frequent letter 1- to 3-grams, most frequent
first.  A document gets the language whose profile is nearest: for each n-gram of
the document's profile the distance grows by how far its rank is out of place,
or by the greatest possible amount if the language's profile lacks it.

Profiles come from counts over all training documents.  N-grams are packed into
64-bit codes, counted per task by sorting, and summed by Spark.  Texts are read in
pieces that end between words, so memory follows the number of different n-grams
(and the longest word), not the length of texts.  The profiles are
``languages x size`` rows, a bound that does not depend on the corpus.

Defined cases: null text or text without a letter is ``und`` with score 0, and so
is everything if nothing could be learned; ties go to the language that is first
by name, ties of frequency to the smaller code; null ids and null languages are
never learned from; repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, remainder, store

SIZE = 300
UNKNOWN = "und"
PIECE = 1 << 18     # characters looked at together
_NONE = np.int64(0x1FFFFF)  # above every code point: marks a place an n-gram doesn't have


_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once per task."""
    if not _TABLE:
        _TABLE.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _TABLE[0]


def grams(text: str) -> np.ndarray:
    """Codes of all letter 1- to 3-grams of a text in lower case; words are set off by one blank on either side."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    c = np.where(letter, points, 0).astype(np.int64)
    c = np.concatenate(([0], c[letter | np.concatenate(([False], letter[:-1]))], [0]))
    if c[-2] == 0:
        c = c[:-1]
    one = c[c > 0] | _NONE << 42 | _NONE << 21
    a, b = c[:-1], c[1:]
    two = (_NONE << 42) | a << 21 | b
    three = a[:-1] << 42 | b[:-1] << 21 | c[2:]
    return np.concatenate((one, two, three[b[:-1] > 0]))


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about ``PIECE`` characters that together have the n-grams of the whole: no n-gram spans two words."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


class Tally:
    """Counts of codes, kept sorted; what was added since is merged before it outgrows them."""

    def __init__(self) -> None:
        self.codes, self.n = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        for piece in _pieces(text.lower()):
            self.waiting.append(grams(piece))
            self.size += len(self.waiting[-1])
            if self.size > 2 * PIECE:
                self.merge()

    def merge(self) -> None:
        if self.waiting:
            new, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            if len(self.codes):
                new, back = np.unique(np.concatenate((self.codes, new)), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate((self.n, n)))
            self.codes, self.n, self.waiting, self.size = new, n.astype(np.int64), [], 0


def profile(codes: np.ndarray, n: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The most frequent codes, most frequent first, ties to the smaller code."""
    return codes[np.argsort(-n, kind="stable")[:size]]


def _count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tallies: dict[str, Tally] = {}
    for batch in batches(rows, 1 << 20):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text:
                tallies.setdefault(lang, Tally()).add(text)
    for lang, tally in tallies.items():
        tally.merge()
        for a in range(0, len(tally.codes), 65536):
            codes, n = tally.codes[a:a + 65536], tally.n[a:a + 65536]
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(codes), "gram": codes, "n": n})


def learn(docs: DataFrame, learnable: Column, size: int = SIZE) -> DataFrame:
    """(lang, gram, rank from 1) from the rows where ``learnable`` holds and lang isn't null."""
    texts = docs.where(learnable & F.col("lang").isNotNull()).select(F.col("lang").cast("string"), "text")
    counts = texts.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size)
    return store(ranked.select("lang", "gram", "rank"))


class Profiles:
    """Ranks by n-gram and language, to compare one document with all languages at once."""

    def __init__(self, rows: list, size: int = SIZE) -> None:
        self.size = size
        self.langs = sorted({r["lang"] for r in rows}, key=lambda x: x.encode())
        self.codes = np.unique(np.array([r["gram"] for r in rows], dtype=np.int64))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, dtype=np.int32)
        for r in rows:
            self.ranks[np.searchsorted(self.codes, r["gram"]), self.langs.index(r["lang"])] = r["rank"]

    def nearest(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 at no distance, 0 at the greatest."""
        if not text or not self.langs:
            return UNKNOWN, 0.0
        tally = Tally()
        tally.add(text)
        tally.merge()
        if not len(tally.codes):
            return UNKNOWN, 0.0
        mine = profile(tally.codes, tally.n, self.size)
        at = np.searchsorted(self.codes, mine)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == mine, at, len(self.codes))
        theirs = self.ranks[at]
        off = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(1, len(mine) + 1)[:, None]))
        total = off.sum(0)
        best = int(np.argmin(total))
        return self.langs[best], float(1.0 - total[best] / (self.size * len(mine)))


def profiles(docs: DataFrame, learnable: Column, size: int = SIZE) -> Profiles:
    return Profiles(learn(docs, learnable, size).collect(), size)


def identify(docs: DataFrame, known: Profiles) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; only the text decides the prediction."""

    def predict(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            found = [known.nearest(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), "text")
    return rows.mapInArrow(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, known: Profiles, least: float) -> DataFrame:
    """The rows of ``docs`` that have a language, with a score of ``least`` at least."""
    place = docs.columns.index("text")

    def keep(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            found = [known.nearest(t) for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
