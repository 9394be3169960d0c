"""Chains over whole texts, and offsets in the text as it is."""

import numpy as np

from loamgrid.llm import toxicity


def tagger(rng):
    words = {f"w{i}": float(x) for i, x in enumerate(rng.normal(0, 2, 40))}
    return toxicity.Tagger(words, -0.5, np.array([[1.5, -1.0], [-1.2, 1.8]]), np.array([-2.0, 3.0, 1.0]))


def test_a_long_text_is_one_chain():
    rng = np.random.default_rng(1)
    t = tagger(rng)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 45, n)) for n in (0, 1, 63, 64, 65, 128, 129, 1000, 0, 5)]
    got, sizes = t.tag(texts)
    at = 0
    for text, n in zip(texts, sizes.tolist(), strict=True):
        if n:
            e = np.array([[t.emission(w) for w in toxicity.tokens(text)]])
            want = toxicity.chain(e, np.ones((1, n), dtype=bool), t.transition)[0][0]
            assert np.allclose(got[at:at + n], want, atol=1e-9)
        at += n
    assert at == len(got)


def test_where_the_batch_cuts_changes_nothing():
    rng = np.random.default_rng(2)
    t = tagger(rng)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 45, n)) for n in (300, 70, 10, 500)]
    together = t.tag(texts)[0]
    assert np.allclose(together, np.concatenate([t.tag([x])[0] for x in texts]), atol=1e-12)


def test_extreme_weights_and_a_very_long_text_stay_finite():
    t = toxicity.Tagger({"bad": 40.0}, -30.0, np.array([[9.0, -9.0], [-9.0, 9.0]]), np.zeros(3))
    p, _ = t.tag(["good " * 100_000 + "bad " * 3 + "good " * 100_000])
    assert np.isfinite(p).all() and p.min() >= 0 and p.max() <= 1


def test_offsets_are_those_of_the_text(spark):
    t = toxicity.Tagger({"vile": 12.0}, -6.0, np.zeros((2, 2)), np.array([-3.0, 6.0, 0.0]))
    text = "İİ calm İ VILE vile end"  # a letter that lower case makes longer
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, text string")
    rows = {r["doc_id"]: r["spans"] for r in toxicity.score(docs, t).collect()}
    a, b = map(int, rows[1].split(":"))
    assert text[a:b] == "VILE vile" and rows[2] == rows[3] == ""
