"""Exact substring removal by relative Lempel-Ziv parsing against indexed reference blocks.

The reference is the corpus itself, cut into blocks whose borders depend on the
content alone: each window of ``WINDOW`` words is anchored at the smallest hash
among its ``SEED``-word sequences, and a block is the run of windows with the same
anchor.  Equal text is therefore cut into equal blocks wherever it occurs.

* Every block is indexed by anchor and by a fingerprint of all its words.  A
  document is parsed greedily, block by block: a block that the index holds more
  than once is copied whole, and consecutive copies make one long factor.
* Where a copy begins or ends within a block, the block itself is new but its
  anchor is not.  At these factor borders the block's windows are compared one
  by one with those of the other blocks of the anchor.

So a window is marked exactly if its words also start anywhere else, and the
words under marked windows are removed.

At scale: blocks, not windows, are shuffled (about one row per 15 words).  Within
a task, repeated blocks are counted before the shuffle, so a block with very many
copies costs a row per task.  An anchor with more than ``LOCAL`` different blocks
sends its windows through one more aggregate instead of holding them in a task.

Defined cases: null text counts as no words; a document shorter than a window
keeps everything; repeated rows are copies of each other; ids may be null or
repeated, rows are told apart by id and text; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, byte_texts, mixed, store, text_key, word_hashes

WINDOW = 35
SEED = 5
LOCAL = 4096
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Fingerprints:
    """64-bit fingerprints of any stretch of a row of word hashes."""

    def __init__(self, words: np.ndarray) -> None:
        self.prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(words * _powers(_BASE, len(words)), dtype=np.uint64)))
        self.undo = _powers(_INVERSE, len(words) + 1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        value = (self.prefix[stop] - self.prefix[start]) * self.undo[start]
        return mixed(value + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _leftmost_smallest(h: np.ndarray, width: int) -> np.ndarray:
    """For each start the place of the smallest of ``width`` values, the leftmost of equals."""
    at, span = np.arange(len(h)), 1
    while span < width:
        step = min(span, width - span)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(h[a] <= h[b], a, b)
        span += step
    return at


def blocks(words: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """Blocks of the documents laid end to end: document, first window, windows, anchor, fingerprint, window fingerprints."""
    none = np.empty(0, dtype=np.int64)
    if len(words) < WINDOW:
        return {"doc": none, "lo": none, "n": none}
    prints = Fingerprints(words)
    seed = np.arange(len(words) - SEED + 1)
    seeds = prints.of(seed, seed + SEED)
    place = _leftmost_smallest(seeds, WINDOW - SEED + 1)[:len(words) - WINDOW + 1]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    start = np.arange(len(place))
    start = start[doc[start] == doc[start + WINDOW - 1]]
    if not len(start):
        return {"doc": none, "lo": none, "n": none}
    place, doc = place[start], doc[start]
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])))
    lo_at = np.flatnonzero(new)
    n = np.diff(np.concatenate((lo_at, [len(start)])))
    lo, anchor_at = start[lo_at], place[lo_at]
    offset = (anchor_at - lo).astype(np.uint64)
    windows = prints.of(start, start + WINDOW)
    return {
        "doc": doc[lo_at], "lo": lo - first[doc[lo_at]], "n": n, "anchor": seeds[anchor_at],
        # the same words cut at the same place relative to the anchor
        "block": mixed(prints.of(lo, lo + n + WINDOW - 1) ^ offset * np.uint64(0xA24BAED4963EE407)),
        "windows": windows, "window_at": lo_at,
    }


_BLOCK_TYPE = "doc_id bigint, key bigint, lo int, n int, anchor bigint, block bigint, copies int, windows binary"


def _cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block; of blocks repeated in the batch all but one need no index (copies = 0) and no windows."""
    for batch in batches(rows, 2 << 20):
        texts = [t.split() for t in byte_texts(batch.column(2))]
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        b = blocks(word_hashes([w for t in texts for w in t]), sizes)
        if not len(b["doc"]):
            continue
        _, first, back, count = np.unique(b["block"], return_index=True, return_inverse=True, return_counts=True)
        copies = np.zeros(len(back), dtype=np.int32)
        copies[first] = np.minimum(count, 2)
        raw, at = b["windows"].tobytes(), b["window_at"] * 8
        windows = [raw[i:i + 8 * n] if c else None for i, n, c in zip(at.tolist(), b["n"].tolist(), copies.tolist(), strict=True)]
        docs = pa.array(b["doc"])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(docs), batch.column(1).take(docs), pa.array(b["lo"].astype(np.int32)), pa.array(b["n"].astype(np.int32)),
             pa.array(b["anchor"].view(np.int64)), pa.array(b["block"].view(np.int64)), pa.array(copies), pa.array(windows, pa.binary())],
            ["doc_id", "key", "lo", "n", "anchor", "block", "copies", "windows"])


class _Out:
    """Marked stretches, and windows left to the aggregate (with their fingerprint)."""

    SCHEMA = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()),
                        ("anchor", pa.int64()), ("window", pa.int64()), ("weight", pa.int32())])

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def flush(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(self.SCHEMA)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.SCHEMA, strict=True)], schema=self.SCHEMA)


def _settle(anchor: int, group: list[tuple], out: _Out) -> None:
    """Windows of an anchor's different blocks: mark those that occur twice; group holds (doc, key, lo, windows, copies)."""
    values = np.concatenate([np.frombuffer(g[3], dtype=np.uint64) for g in group])
    lengths = np.array([len(g[3]) // 8 for g in group])
    weight = np.repeat([g[4] for g in group], lengths)
    uniq, back = np.unique(values, return_inverse=True)
    twice = np.bincount(back, weights=weight, minlength=len(uniq)) >= 2
    hit, at = twice[back], 0
    for (doc, key, lo, _, copies), n in zip(group, lengths.tolist(), strict=True):
        if copies < 2:  # copied blocks are marked whole
            for i in np.flatnonzero(hit[at:at + n]).tolist():
                out.rows.append((doc, key, lo + i, lo + i + WINDOW, None, None, None))
        at += n


def _parse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor and block: mark copied blocks; settle or pass on the windows of the others."""
    out, anchor, block = _Out(), None, None
    run: list = []          # the first row of the current block: doc, key, lo, n, windows, copies
    group: list[tuple] = []  # different blocks of the anchor so far
    spilled = False

    def close_block() -> None:
        nonlocal spilled
        if run:
            doc, key, lo, n, windows, copies = run
            if copies >= 2:
                out.rows.append((doc, key, lo, lo + n + WINDOW - 1, None, None, None))
            group.append((doc, key, lo, windows, min(copies, 2)))
            if len(group) > LOCAL:
                spilled = True
                pass_on()

    def pass_on() -> None:
        for doc, key, lo, windows, copies in group:
            for i, w in enumerate(np.frombuffer(windows, dtype=np.int64).tolist()):
                out.rows.append((doc, key, lo + i, lo + i + WINDOW, anchor, w, copies))
        group.clear()

    def close_anchor() -> None:
        nonlocal spilled
        if spilled:
            pass_on()
        elif len(group) > 1:
            _settle(anchor, group, out)
        group.clear()
        spilled = False

    for batch in rows:
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "key", "lo", "n", "anchor", "block", "copies", "windows")]
        for doc, key, lo, n, a, b, copies, windows in zip(*columns, strict=True):
            if a == anchor and b == block:
                out.rows.append((doc, key, lo, lo + n + WINDOW - 1, None, None, None))
                run[5] = 2
                continue
            close_block()
            if a != anchor:
                close_anchor()
            anchor, block, run = a, b, [doc, key, lo, n, windows, copies]
        yield out.flush()
    close_block()
    close_anchor()
    yield out.flush()


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, start, stop) in words, overlapping: every word under a repeated window and no other."""
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("key"), F.col("text").cast("string"))
    cut = rows.mapInArrow(_cut, _BLOCK_TYPE)
    # repeats within a batch are copies already; they travel alone, not to the anchor's task
    keyed = cut.withColumn("deal", F.when(F.col("copies") == 0, F.xxhash64("key", "lo")).otherwise(F.col("anchor")))
    dealt = keyed.repartition("deal").sortWithinPartitions("anchor", "block", "copies")
    kind = "doc_id bigint, key bigint, start int, stop int, anchor bigint, window bigint, weight int"
    found = store(dealt.mapInArrow(_split, kind))
    open_windows = found.where("window is not null")
    total = Window.partitionBy("anchor", "window")
    settled = open_windows.withColumn("total", F.sum("weight").over(total)).where("total >= 2")
    return found.where("window is null").select("doc_id", "key", "start", "stop").unionByName(settled.select("doc_id", "key", "start", "stop"))


def _split(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies found before the shuffle are marked at once; the others are parsed in order."""
    sure = _Out()

    def indexed() -> Iterator[pa.RecordBatch]:
        for batch in rows:
            copies = batch.column(6).to_numpy()
            part = batch.filter(pa.array(copies == 0))
            for doc, key, lo, n in zip(*(part.column(c).to_pylist() for c in ("doc_id", "key", "lo", "n")), strict=True):
                sure.rows.append((doc, key, lo, lo + n + WINDOW - 1, None, None, None))
            yield batch.filter(pa.array(copies > 0))

    for out in _parse(indexed()):
        if sure.rows:
            yield sure.flush()
        if out.num_rows:
            yield out
    yield sure.flush()


def remove_repeats(docs: DataFrame, *, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept text) for every row of ``docs``."""
    spans = repeated_spans(docs).groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("key"), F.col("text").cast("string"))
    spans = spans.withColumnsRenamed({"doc_id": "d", "key": "k"})
    joined = rows.join(spans, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d")), "left").select("doc_id", "text", "spans")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(parts):
            n, gone, digest, kept_text = [], [], [], []
            # spans stay in their columns: as objects they would take some thirty times the bytes
            held, flat = batch.column(2), batch.column(2).flatten()
            ends = np.cumsum(held.value_lengths().fill_null(0).to_numpy())
            starts, stops = (flat.field(i).to_numpy() for i in (0, 1))
            begin = 0
            for text, end in zip(byte_texts(batch.column(1)), ends.tolist(), strict=True):
                words = text.split()
                n.append(len(words))
                at, begin = slice(begin, end), end
                if at.start < at.stop:
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(depth, starts[at], 1)
                    np.add.at(depth, stops[at], -1)
                    keep = np.cumsum(depth)[:-1] == 0
                    words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                gone.append(n[-1] - len(words))
                body = b" ".join(words)
                digest.append(hashlib.sha256(body).hexdigest())
                kept_text.append(body.decode("utf-8", "replace") if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest), pa.array(kept_text, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "text"])

    out = joined.mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, text string")
    return out if keep_text else out.drop("text")
