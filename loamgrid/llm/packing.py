"""Packing token streams into sequences: order-preserving dynamic programming over cut positions.

The documents of a partition, in their order, are one stream of token ids, each
document followed by one end id.  A sequence is a window of at most ``LENGTH`` ids
of that stream.  Windows are chosen by dynamic programming over *cuts*: ends of
documents (free), ends of sentences (``SENTENCE``) and, where neither comes for
``STRIDE`` ids, a position in between (``INSIDE``).  What is minimised is padding
plus these truncation penalties:

    cost(j) = penalty(j) + min over i of  cost(i) + padding(j - i)

Padding is ``LENGTH - n``, and nothing if n is a power of two.  For the first kind
``cost(i) - i`` is all that matters, so the least of the window comes from a
monotone queue in constant time; the second kind has eleven possible
predecessors, looked up by position.

Nothing is shuffled: each task packs its own part of the scan, block by block.  A
block ends with the batch; what lies behind its cheapest last cut, less than a
window, is carried into the next block, so only a partition's end can be short.  Memory is bounded by a batch (or by one
longer document).  A task that is run again reads the same rows in the same order
and gives the same sequences: a sequence's id is its partition's number times 2^33
plus a count.

Token ids are those of the ``tokenizers`` file named.  Byte pairs never merge
across a single blank between two other characters, so the distinct words of a
batch are encoded once, as one text, and put together again by position; the
encoder for this has the file's own vocabulary as its ranks.  Texts where that
rule does not hold are encoded whole, and texts with special tokens or with
control characters that encoders read differently go to ``tokenizers`` itself.

Defined cases: null text is empty and gives the end id alone; null ids and
repeated rows are documents like any other; other columns are ignored, whatever
their names; an empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

LENGTH = 1024
END = 0
SENTENCE = 4    # what a cut at the end of a sentence costs, in ids of padding
INSIDE = 12     # what any other cut within a document costs
STRIDE = 32     # ids after which a place without a sentence's end may be cut
BATCH = 16 << 20

_W = r"[\s\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# blanks next to other white space, and white space at either end
_LOOSE = rf"^{_W}|{_W}$|{_W}\x20|\x20{_W}|^[^ ]*$"
# special tokens, and characters that encoders take differently for white space
_ODD = r"<\||[\x{1c}-\x{1f}]"
# what a sentence ends with, perhaps followed by a closing mark
_CLOSED = re.compile(rb"[.!?][\"')\]]?\s*$|\n\s*$")


def _byte_of() -> dict[str, int]:
    """The character a byte-level vocabulary writes for each byte: itself if printable, else the next free one."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Encoder:
    """Token ids of many texts at once."""

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.whole = Tokenizer.from_file(path)
        byte = _byte_of()
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        ranks = {bytes(byte[c] for c in t): i for t, i in self.whole.get_vocab().items() if t not in special}
        # Fixed value: the word pattern of this family of byte-level vocabularies.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        self.closes = np.zeros(len(self.size), dtype=bool)
        for token, i in ranks.items():
            self.size[i] = len(token)
            self.closes[i] = bool(_CLOSED.search(token))

    def one(self, text: str, odd: bool) -> np.ndarray:
        ids = self.whole.encode(text, add_special_tokens=False).ids if odd else self.plain.encode_ordinary(text)
        return np.array(ids, dtype=np.uint32)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word with a blank before it, one after the other, and where each word's begin."""
        joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(words)], words), pa.scalar(" ", words.type))
        ids = np.array(self.plain.encode_ordinary(" " + joined[0].as_py()), dtype=np.uint32)
        starts = np.concatenate(([0], np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1)))
        return ids, np.searchsorted(np.concatenate(([0], np.cumsum(self.size[ids]))), starts)

    def many(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of every text, each followed by the end id."""
        rows = [t or "" for t in texts.to_pylist()]
        out: list[np.ndarray] = [np.empty(0, dtype=np.uint32)] * len(rows)
        end = np.array([END], dtype=np.uint32)
        filled = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(filled, _ODD)
        loose = pc.or_(odd, pc.match_substring_regex(filled, _LOOSE))
        for i in pc.indices_nonzero(loose).to_pylist():
            out[i] = np.concatenate((self.one(rows[i], odd[i].as_py()), end))
        tidy = pc.indices_nonzero(pc.invert(loose)).to_pylist()
        if not tidy:
            return out
        split = pc.split_pattern(filled.take(pa.array(tidy)).cast(pa.large_string()), " ")
        offsets = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        code = coded.indices.to_numpy()
        # nothing comes before a text's first word, so it is encoded alone
        later = np.ones(len(code), dtype=bool)
        later[offsets[:-1]] = False
        used = np.unique(code[later])
        ids, at = self._words(coded.dictionary.take(pa.array(used)))
        place = np.zeros(len(coded.dictionary), dtype=np.int64)
        place[used] = np.arange(len(used))
        n = np.diff(at)
        words = place[code]
        sizes = np.where(later, n[words], 0)
        upto = np.concatenate(([0], np.cumsum(sizes)))
        flat = ids[np.repeat(at[words] - upto[:-1], sizes) + np.arange(upto[-1])]
        for i, a, b in zip(tidy, upto[offsets[:-1]].tolist(), upto[offsets[1:]].tolist(), strict=True):
            head = self.plain.encode_ordinary(rows[i][:rows[i].index(" ")])
            out[i] = np.concatenate((np.array(head, dtype=np.uint32), flat[a:b], end))
        return out


def cuts(closes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions a window may end at, and what ending there costs; ``ends`` are ends of documents."""
    price = np.where(closes, SENTENCE, -1)
    price[ends - 1] = 0
    fixed = np.flatnonzero(price >= 0) + 1
    gap = np.diff(fixed, prepend=0)
    more = np.maximum(0, (gap - 1) // STRIDE)
    base = np.repeat(fixed - gap, more)
    price[base + STRIDE * (np.arange(len(base)) - np.repeat(np.cumsum(more) - more, more) + 1) - 1] = INSIDE
    at = np.flatnonzero(price >= 0)
    return at + 1, price[at]


def windows(at: np.ndarray, cost: np.ndarray, length: int = LENGTH, *, more: bool = False) -> list[int]:
    """The cuts of the cheapest windows over positions 0 to ``at[-1]``, 0 first; of equal ones the longest last window.

    If ``more`` follows, the windows end at the cheapest of the last cuts instead, as what comes after isn't known yet.
    """
    n = len(at) + 1
    where = np.concatenate(([0], at))
    # predecessors a power of two away
    number = np.full(int(where[-1]) + 1, -1, dtype=np.int64)
    number[where] = np.arange(n)
    later, earlier = [], []
    size = 1
    while size <= length:
        j = np.flatnonzero(where >= size)
        i = number[where[j] - size]
        later.append(j[i >= 0])
        earlier.append(i[i >= 0])
        size *= 2
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    first = np.searchsorted(later[order], np.arange(n + 1)).tolist()
    exact = earlier[order].tolist()
    place, penalty = where.tolist(), [0, *cost.tolist()]
    best, back = [0] * n, [0] * n
    # a monotone queue of cuts by cost + position, rising; the least in front
    queue, key, front = [0], [0], 0
    for j, here in enumerate(place[1:], 1):
        while here - place[queue[front]] > length:
            front += 1
        source = queue[front]
        least = key[front] + length - here
        for x in range(first[j], first[j + 1]):
            i = exact[x]
            if best[i] < least or (best[i] == least and i < source):
                least, source = best[i], i
        best[j] = least = least + penalty[j]
        back[j] = source
        least += here
        while len(key) > front and key[-1] > least:
            key.pop()
            queue.pop()
        key.append(least)
        queue.append(j)
    stop = n - 1
    if more:
        stop = min(range(int(np.searchsorted(where, where[-1] - length, side="right")), n), key=lambda j: (best[j], -j))
    out = [stop]
    while out[-1]:
        out.append(back[out[-1]])
    return [place[j] for j in reversed(out)]


@dataclass
class _Stream:
    """Ids in the order of their documents."""

    ids: np.ndarray
    docs: list[tuple[int | None, int]]  # doc_id, doc_tokens
    begin: np.ndarray                   # position of each document's first id here; negative if it began earlier


_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _pieces(stream: _Stream, marks: list[int], first: int) -> pa.RecordBatch:
    """The windows between ``marks``, cut where documents meet."""
    here = stream.begin[(stream.begin > 0) & (stream.begin < marks[-1])]
    edge = np.union1d(marks, here)
    start, length = edge[:-1], np.diff(edge)
    doc = np.searchsorted(stream.begin, start, side="right") - 1
    window = np.searchsorted(marks, start, side="right") - 1
    data = memoryview(stream.ids.astype("<u4").tobytes())
    crc = [zlib.crc32(data[4 * a:4 * (a + n)]) for a, n in zip(start.tolist(), length.tolist(), strict=True)]
    docs = [stream.docs[d] for d in doc.tolist()]
    columns = [
        [d[0] for d in docs], start - stream.begin[doc], length, crc, [d[1] for d in docs], first + window, start - np.asarray(marks)[window]]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_PIECES)


def pack(docs: DataFrame, tokenizer: str, *, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        first = TaskContext.get().partitionId() << 33
        left = _Stream(np.empty(0, dtype=np.uint32), [], np.empty(0, dtype=np.int64))

        def block(stream: _Stream, last: bool) -> tuple[_Stream, pa.RecordBatch, int]:
            ends = np.append(stream.begin[1:], len(stream.ids))
            marks = windows(*cuts(encoder.closes[stream.ids], ends), length, more=not last)
            used = marks[-1]
            keep = int(np.searchsorted(ends, used, side="right"))
            rest = _Stream(stream.ids[used:], stream.docs[keep:], stream.begin[keep:] - used)
            return rest, _pieces(stream, marks, first) if used else pa.RecordBatch.from_pylist([], schema=_PIECES), len(marks) - 1

        for batch in batches(rows, BATCH):
            found = encoder.many(batch.column(1))
            if not found:
                continue
            sizes = np.array([len(x) for x in found])
            begin = np.concatenate((left.begin, len(left.ids) + np.cumsum(sizes) - sizes))
            names = left.docs + list(zip(batch.column(0).to_pylist(), sizes.tolist(), strict=True))
            left, out, n = block(_Stream(np.concatenate([left.ids, *found]), names, begin), False)
            first += n
            yield out
        if len(left.ids):
            yield block(left, True)[1]

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        run, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
