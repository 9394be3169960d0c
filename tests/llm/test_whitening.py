import numpy as np
import pytest

from loamgrid.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, n bigint, x string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], 0, 1, "x") for i, v in vectors], SCHEMA)


def check(rows, vectors, components=8):
    """Against the covariance formed whole, in exact integers."""
    used = [(i, v) for i, v in vectors if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(1024 * np.array([np.float32(v) for _, v in used], dtype=np.float64)).astype(np.int64) + 100000
    n, s = len(x), x.sum(0)
    d = n * x - s
    xc = d / n
    value, vector = np.linalg.eigh(xc.T @ xc / n)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(components, int((value > 1e-12 * value[0]).sum()))
    want = xc @ vector[:, :k] / np.sqrt(value[:k])
    assert len(rows) == n * k
    deviation = (d * d).sum(1)
    got = np.full((n, k), np.nan)
    place = {i: r for r, (i, _) in enumerate(used)}
    for r in rows:
        got[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[place[r["vec_id"]]]
        assert abs(r["explained"] / (value[r["component"] - 1] / value.sum()) - 1) < 1e-8
        assert 0 <= r["identity_error"] < 1e-8
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < 1e-6


@pytest.mark.parametrize(("n", "dim"), [(700, 64), (300, 40), (60, 5), (40, 1), (6, 30)])
def test_components_equal_those_of_the_whole_covariance(spark, n, dim):
    rng = np.random.default_rng(n)
    data = rng.standard_normal((n, dim)) * np.linspace(1, 2, dim)
    vectors = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(data)]
    check(whitening.whiten(frame(spark, vectors).repartition(3)).collect(), vectors)


def test_sums_in_two_levels(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rng.standard_normal((400, 12)))]
    rows = whitening.integers(frame(spark, vectors)).repartition(70).cache()
    v = whitening.Covariance(rows)
    assert v.parts > 64
    q = np.eye(12)[:, :3]
    x = np.array([r["x"] for r in rows.collect()])
    x = x - x.mean(0)
    assert np.allclose(v.times(q), x.T @ (x @ q) / len(x), rtol=1e-12)


def test_nearly_equal_eigenvalues_and_a_start_that_misses_one():
    rng = np.random.default_rng(8)
    q = np.linalg.qr(rng.standard_normal((80, 80)))[0]
    value = np.concatenate(([30, 20, 20 - 1e-6], np.linspace(19, 15, 77)))
    v = (q * value) @ q.T
    got, vector = whitening.leading(lambda b: v @ b, 80, 8)
    assert np.allclose(got, value[:8], rtol=1e-11)
    assert np.linalg.norm(v @ vector - vector * got, axis=0).max() < 1e-9
    # an image that hides the largest direction from the first steps: only a fresh probe can show it
    calls = []

    def hiding(b):
        calls.append(1)
        hidden = v - value[0] * np.outer(q[:, 0], q[:, 0])
        return (hidden if len(calls) <= whitening.WARM + 1 else v) @ b

    got, _ = whitening.leading(hiding, 80, 8)
    assert np.allclose(got, value[:8], rtol=1e-11)


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    good = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rng.standard_normal((50, 6)))]
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (101, [1.0, None, 0, 0, 0, 0]), (102, [nan] * 6), (103, [0.0, 0, 0, 0, 0, inf]), (104, [1.0]), (105, []), (106, [3e38] * 6)]
    same = [(200, good[0][1]), (201, [0.0] * 6)]
    rows = whitening.whiten(frame(spark, good + odd + same)).collect()
    assert {r["vec_id"] for r in rows} == {i for i, _ in good + same}
    check(rows, good + same)
    twice = [(r["vec_id"], r["component"]) for r in whitening.whiten(frame(spark, [*good, good[0], (None, good[1][1])])).collect()]
    assert twice.count((0, 1)) == 2 and twice.count((None, 1)) == 1
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, odd[:1])).collect() == []


def test_deviation_beyond_64_bits():
    c = whitening.centred(np.array([[1 << 45, 0], [0, 1]]), 1 << 20, [5, 6])
    assert c.dtype == object and whitening.deviations(c)[0] is None
    assert whitening.deviations(c)[1] == 25 + ((1 << 20) - 6) ** 2
