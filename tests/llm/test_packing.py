import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loamgrid.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(PATH)


def expected(encoder, text):
    return encoder.whole.encode(text or "", add_special_tokens=False).ids + [packing.END]


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from("ab Z1 \n\t.,'sé　中\x1c\U0001f600<|endoftxt>"), max_size=40), max_size=6))
def test_ids_are_those_of_the_tokenizer(encoder, texts):
    texts = [*texts, None, "a <|endoftext|> b", "it's one two", "trailing \n"]
    found = encoder.many(pa.array(texts, pa.string()))
    assert [f.tolist() for f in found] == [expected(encoder, t) for t in texts]


def padding(n, length):
    return 0 if n & (n - 1) == 0 else length - n


def total(marks, at, cost, length):
    price = dict(zip(at.tolist(), cost.tolist(), strict=True))
    return sum(padding(b - a, length) + price[b] for a, b in pairwise(marks))


@settings(max_examples=80, deadline=None)
@given(gaps=st.lists(st.integers(1, 9), min_size=1, max_size=12), data=st.data())
def test_windows_cost_as_little_as_any_choice_of_cuts(gaps, data):
    at = np.cumsum(gaps)
    cost = np.array(data.draw(st.lists(st.sampled_from([0, 4, 12]), min_size=len(gaps), max_size=len(gaps))))
    marks = packing.windows(at, cost, length=16)
    assert marks[0] == 0 and marks[-1] == at[-1] and all(0 < b - a <= 16 for a, b in pairwise(marks))
    best = {0: 0}
    for j, c in zip(at.tolist(), cost.tolist(), strict=True):
        best[j] = c + min(best[i] + padding(j - i, 16) for i in best if j - i <= 16)
    assert total(marks, at, cost, 16) == best[int(at[-1])]


def test_cuts_are_never_far_apart():
    closes = np.zeros(200, dtype=bool)
    closes[[9, 150]] = True
    at, cost = packing.cuts(closes, np.array([12, 200]))
    assert np.diff(at, prepend=0).max() <= packing.STRIDE
    priced = dict(zip(at.tolist(), cost.tolist(), strict=True))
    assert priced[10] == priced[151] == packing.SENTENCE and priced[12] == priced[200] == 0 and priced[44] == packing.INSIDE


def check(rows, docs, encoder):
    """Every id of every document in exactly one piece, sequences without gaps and not above their length."""
    want = {}
    for doc, text in docs:
        want.setdefault(doc, []).append(expected(encoder, text))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(want)
    for doc, found in pieces.items():
        copies = len(want[doc])
        assert sum(r["length"] for r in found) == sum(map(len, want[doc]))
        assert sum(r["start"] == 0 for r in found) == copies
        for r in found:
            assert any(
                r["doc_tokens"] == len(ids)
                and r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], dtype="<u4").tobytes()) for ids in want[doc])
        if copies == 1:
            spans = sorted((r["start"], r["length"]) for r in found)
            assert all(a + n == b for (a, n), (b, _) in pairwise(spans)) and spans[0][0] == 0
    filled = 0
    for found in sequences.values():
        spans = sorted((r["offset"], r["length"]) for r in found)
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in pairwise(spans))
        n = sum(length for _, length in spans)
        assert 0 < n <= packing.LENGTH
        filled += padding(n, packing.LENGTH)
    return filled


def test_odd_documents(spark, odd_docs, no_docs, encoder):
    rows = packing.pack(odd_docs.repartition(2), PATH).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in odd_docs.collect()], encoder)
    assert [r["length"] for r in rows if r["doc_id"] == 3] == [1]
    empty = packing.pack(no_docs, PATH)
    assert empty.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and empty.count() == 0


def test_little_padding_in_several_blocks(spark, encoder, monkeypatch):
    monkeypatch.setattr(packing, "BATCH", 20_000)
    docs = [(i, " ".join(f"word{i * j % 97} is here{'.' if j % 9 == 0 else ''}" for j in range(1 + i * 7 % 400))) for i in range(300)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(2), PATH).collect()
    padded = check(rows, docs, encoder)
    assert padded <= 0.02 * sum(r["length"] for r in rows)
    ordered = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))]
    firsts = list(dict.fromkeys(ordered))
    assert firsts == sorted(firsts)
