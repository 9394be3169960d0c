"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers ``x = floor(1024 * c) + 100000``, stored once.  The leading
eigenvectors of their covariance V are found without ever forming V: all that is
asked of the data is ``V Q = Xc' (Xc Q) / n`` for a narrow block Q, one pass of
partial products over the stored rows each.

* A few Lanczos steps with a random vector, in the same passes as the first plain
  steps of the block, bound the spectrum from below.
* The Chebyshev polynomial of degree ``degree`` for the interval from there to the
  block's smallest Ritz value is applied by its three-term recurrence, a pass a
  term: it damps what lies in the interval and lifts what lies above.
* QR makes the block orthonormal, Rayleigh-Ritz turns it into Ritz vectors; the next
  filter uses the new interval.
* *Certificate.*  The residuals ``|V q - e q|`` of the wanted vectors have to fall to
  ``TIGHT`` of the largest eigenvalue, or to stop falling below ``ENOUGH`` of it,
  where rounding ends.  Every filter also carries ``PROBES`` fresh random vectors; if
  the block had missed a direction, a probe would lift it above the wanted ones, so
  their eigenvalues also have to be the same as in the round before.

A task sums its rows' products into a matrix of dimensions x block; the matrices of
the tasks are summed by Spark in two levels, in a fixed order, so the driver holds
what depends on the dimensions alone.  Integers are centred exactly, as ``n * x - S``.

Defined cases: vectors that are null or empty, or hold null or non-finite entries,
are dropped, as are those of another length than the most frequent one (the longer
of equally frequent ones) and those with an entry whose x isn't below 2^49; null ids
and repeated rows are rows like any other; components without variance to speak of
(``FLAT`` of the largest) aren't returned, as they can't be whitened, so equal
vectors give an empty result, as does an empty table; with fewer dimensions than
components there are as many as dimensions; a deviation beyond 64 bits is null;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

SCALE, SHIFT = 1024, 100_000
FLAT = 1e-12
TIGHT, ENOUGH = 2e-14, 1e-10
PROBES = 2
WARM = 6        # Lanczos steps, and plain steps of the block
WIDE = 1 << 49


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, x (array<bigint>) of the rows that take part."""
    c = F.transform("embedding", lambda e: e.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("c")).where("c is not null and size(c) > 0")
    rows = rows.where(F.forall("c", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) * SCALE < WIDE), F.lit(False))))
    usual = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).select("d")
    rows = rows.join(F.broadcast(usual), F.size("c") == F.col("d"))  # one row
    return rows.select("vec_id", F.transform("c", lambda e: F.floor(e * SCALE).cast("long") + F.lit(SHIFT).cast("long")).alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in parts:
            if batch.num_rows:
                here = _matrix(batch.column(0)).sum(0).tolist()
                n, total = n + batch.num_rows, here if total is None else [a + b for a, b in zip(total, here, strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([json.dumps([n, *total])])], ["sums"])

    total: list[int] = []
    for r in rows.select("x").mapInArrow(run, "sums string").toLocalIterator():
        here = json.loads(r["sums"])
        total = [a + b for a, b in zip(total, here, strict=True)] if total else here
    return (total[0], total[1:]) if total else (0, [])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: 64-bit integers, or Python's where those could overflow."""
    if n * int(max(abs(int(x.max())), abs(int(x.min())))) < 1 << 61:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def deviations(c: np.ndarray) -> list[int | None]:
    """Sum of squares by row, exact; null beyond 64 bits."""
    if c.dtype != object and (np.square(c, dtype=np.float64).sum(1) < 2.0**62).all():
        return (c * c).sum(1).tolist()
    exact = (sum(v * v for v in row) for row in c.tolist())
    return [e if e < 1 << 63 else None for e in exact]


class Covariance:
    """V times a block, one pass over the stored rows at a time."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows.select("x")
        self.n, self.sums = _sums(rows)
        self.dim = len(self.sums)
        self.passes = 1
        self.parts = self.rows.rdd.getNumPartitions()

    def total(self, product: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all rows of ``product`` of the centred rows."""
        n, sums = self.n, self.sums

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            out = None
            for batch in parts:
                if batch.num_rows:
                    here = product(centred(_matrix(batch.column(0)), n, sums).astype(np.float64) / n)
                    out = here if out is None else out + here
            if out is not None:
                yield packed(TaskContext.get().partitionId(), out)

        def packed(part: int, m: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([list(m.shape)], pa.list_(pa.int64())), pa.array([m.tobytes()], pa.binary())],
                ["part", "shape", "m"])

        def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = sorted((r for batch in parts for r in batch.to_pylist()), key=lambda r: r["part"])
            if found:
                yield packed(found[0]["part"], sum(np.frombuffer(r["m"]).reshape(r["shape"]) for r in found))

        kind = "part bigint, shape array<bigint>, m binary"
        partial = self.rows.mapInArrow(run, kind)
        if self.parts > 64:
            groups = isqrt(self.parts)
            partial = partial.repartition(groups, F.pmod(F.col("part"), F.lit(groups))).mapInArrow(add, kind)
        self.passes += 1
        found = sorted(partial.collect(), key=lambda r: r["part"])  # a matrix of fixed size a group of tasks
        return sum(np.frombuffer(bytes(r["m"])).reshape(r["shape"]) for r in found)

    def times(self, block: np.ndarray) -> np.ndarray:
        return self.total(lambda x: x.T @ (x @ block)) / self.n

    def trace(self) -> float:
        return float(self.total(lambda x: np.array([np.square(x).sum()]))[0]) / self.n


def _ritz(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, with their vectors and images, of an orthonormal block and V times it."""
    h = block.T @ image
    value, vector = np.linalg.eigh((h + h.T) / 2)
    vector = vector[:, ::-1]
    return value[::-1], block @ vector, image @ vector


def _lowest(alpha: list[float], beta: list[float]) -> float:
    """A bound of the spectrum from below: the least Ritz value of the Lanczos steps less the last residual."""
    t = np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - abs(beta[-1]))


def _filtered(times: Callable[[np.ndarray], np.ndarray], block: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial of V that is small on [low, high] and one at ``top``, times the block."""
    middle, half = (high + low) / 2, (high - low) / 2
    sigma = first = half / (top - middle)
    before, now = block, (times(block) - middle * block) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now) - middle * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def leading(times: Callable[[np.ndarray], np.ndarray], dim: int, k: int, *, guard: int = 16, degree: int = 10, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their vectors, certified as the module states."""
    rng = np.random.default_rng(seed)
    k = min(k, dim)
    width = min(dim, k + guard)
    block = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    if width == dim:
        value, vector, _ = _ritz(block, times(block))
        return value[:k], vector[:, :k]
    w, past, alpha, beta = rng.standard_normal(dim), [], [], []
    w /= np.linalg.norm(w)
    for _ in range(min(WARM, dim - 1)):
        image = times(np.column_stack((block, w)))
        past.append(w)
        alpha.append(float(w @ image[:, -1]))
        r = image[:, -1]
        for _ in range(2):
            r = r - np.column_stack(past) @ (np.column_stack(past).T @ r)
        beta.append(float(np.linalg.norm(r)))
        block = np.linalg.qr(image[:, :-1])[0]
        if beta[-1] <= FLAT * max(alpha):
            beta[-1] = 0.0
            break
        w = r / beta[-1]
    low = _lowest(alpha, beta)
    value, vector, image = _ritz(block, times(block))
    residual = np.inf
    while True:
        worst = float(np.linalg.norm(image[:, :k] - vector[:, :k] * value[:k], axis=0).max())
        top = max(float(value[0]), 1e-300)
        steady = residual < np.inf and float(np.abs(value[:k] - last).max()) <= ENOUGH * top
        if steady and (worst <= TIGHT * top or (worst <= ENOUGH * top and worst > residual / 4)):
            return value[:k], vector[:, :k]
        if value[width - 1] <= FLAT * top:  # the block holds everything that varies
            if residual < np.inf and worst <= ENOUGH * top:
                return value[:k], vector[:, :k]
            low = 0.0
        high = max(float(value[width - 1]), low + 1e-9 * top)
        residual, last = worst, value[:k]
        probes = rng.standard_normal((dim, min(PROBES, dim - width)))
        probes -= vector @ (vector.T @ probes)
        wide = np.column_stack((vector, probes / np.maximum(np.linalg.norm(probes, axis=0), 1e-300)))
        block = np.linalg.qr(_filtered(times, wide, low, high, top, degree))[0]
        value, vector, image = (m[..., :width] for m in _ritz(block, times(block)))


def whiten(vectors: DataFrame, *, components: int = 8, guard: int = 16, degree: int = 10) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per vector and component."""
    kind = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = store(integers(vectors))
    v = Covariance(rows)
    trace = v.trace() if v.n else 0.0
    if trace <= 0:
        return vectors.sparkSession.createDataFrame([], kind)
    value, vector = leading(v.times, v.dim, components, guard=guard, degree=degree)
    good = value > FLAT * value[0]
    value, basis = value[good], (vector / np.sqrt(np.maximum(value, 1e-300)))[:, good]
    k, n, sums = len(value), v.n, v.sums

    def moments(x: np.ndarray) -> np.ndarray:
        y = x @ basis
        return np.vstack((y.T @ y, y.sum(0)))

    total = v.total(moments) / n
    error = float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
    explained = value / trace

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if batch.num_rows:
                c = centred(_matrix(batch.column(1)), n, sums)
                m = len(c)
                y = (c.astype(np.float64) / n) @ basis
                deviation = pa.array(deviations(c), pa.int64())
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     deviation.take(each), pa.array(y.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, kind)
