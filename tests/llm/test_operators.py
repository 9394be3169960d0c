"""Defined results on awkward rows, and brute-force versions of what SQL cannot express."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamgrid.llm import ann, classlm, decontam, language, licences, mixing, neardup, pii, substrings, toxicity
from loamgrid.llm.common import components, remainder, word_hashes

from .conftest import WORDS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_personal_data(spark, odd_docs, no_docs):
    rows = pii.personal_data(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    hit = next(r for r in rows if r["doc_id"] is None)
    assert (hit["n_email"], hit["n_phone"]) == (1, 1)
    assert hit["spans"] == "email:11:31,phone:35:52"
    assert pii.personal_data(no_docs).count() == 0
    clean = {r["doc_id"]: r["text"] for r in pii.redact(odd_docs).collect()}
    assert clean[None] == "mail me at <EMAIL> or <PHONE>" and clean[3] is None and clean[4] == ""
    assert pii.redact(odd_docs).columns == odd_docs.columns


@pytest.mark.parametrize("text", ["a@b.c.d@e.f", "x@y @z.w q@r.s", "1.2.3.4.5.6.7.8 999.1.1.1 1.1.1.1", "4111 1111 1111 1111 0", "+1 22-33 (44) 55 66 +1"])
def test_base_patterns(text):
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda s: re.sub(r"\D", "", s)
    want = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    want += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) < 256 for p in m[0].split("."))]
    want += [("card", *m.span()) for m in re.finditer(r"[0-9]([ -]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    want += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][ ().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    assert sorted(want) == sorted(f[:3] for f in pii.find(text) if f[3])


def test_language(spark, odd_docs, no_docs):
    known = language.profiles(odd_docs, remainder(F.col("doc_id"), 3) != 1)
    rows = {r["doc_id"]: r for r in language.identify(odd_docs, known).collect()}
    assert [rows[i]["lang_pred"] for i in (1, 3, 4, 5, 8)] == ["en", "und", "und", "und", "und"]
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    empty = language.profiles(no_docs, remainder(F.col("doc_id"), 3) != 1)
    assert {r["lang_pred"] for r in language.identify(odd_docs, empty).collect()} == {"und"}
    kept = language.keep_identified(odd_docs, known, 0.0)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 1").count() == 2


def test_toxicity(spark, odd_docs, no_docs):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("aeioutns") for _ in range(6))
    docs, labels = [], []
    for i in range(400):
        w = [word() for _ in range(60)]
        if i % 5 == 0:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(["zorgle", "vlimp"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    labels = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    tagger = toxicity.fit(docs, labels)
    out = toxicity.score(docs, tagger).collect()
    assert all(r["predicted"] == (r["doc_id"] % 5 == 0) for r in out if r["held_out"])
    odd = toxicity.score(odd_docs, tagger).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    none = toxicity.fit(no_docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(odd_docs, none).collect()} == {0}


def test_chain_against_enumeration():
    rng = np.random.default_rng(0)
    e, t = rng.standard_normal((1, 4)), rng.standard_normal((2, 2))
    mask = np.ones((1, 4), dtype=bool)
    p, pairs, norm = toxicity.chain(e, mask, t)
    total, hit = 0.0, np.zeros(4)
    for s in range(16):
        y = [s >> i & 1 for i in range(4)]
        w = math.exp(sum(e[0, i] * y[i] for i in range(4)) + sum(t[y[i], y[i + 1]] for i in range(3)))
        total += w
        hit += w * np.array(y)
    assert np.allclose(p[0], hit / total) and math.isclose(norm, math.log(total)) and math.isclose(pairs.sum(), 3)


def _brute_components(texts, width, percent):
    sets = {}
    for i, t in texts:
        w = [x.lower() for x in WORD.findall(t)]
        sets[i] = {tuple(w[j:j + width]) for j in range(max(1, len(w) - width + 1))} if w else set()
    top = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                k = len(sets[a] & sets[b])
                if k and percent[1] * k >= percent[0] * len(sets[a] | sets[b]) and top[a] != top[b]:
                    top[a] = top[b] = min(top[a], top[b])
                    changed = True
    return top


def test_near_duplicates(spark, odd_docs, no_docs, monkeypatch):
    rng = random.Random(5)
    texts = []
    for i in range(60):
        w = [f"w{j}" for j in range(120)]
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            w[rng.randrange(120)] = f"x{rng.random()}"
        texts.append((i, " ".join(w)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    want = _brute_components(texts, 3, (85, 100))
    monkeypatch.setattr(neardup, "SMALL", 3)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, width=3, percent=(85, 100)).collect()}
    assert got == want
    odd = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(odd_docs).collect()}
    n = len(WORDS) - 4
    assert {(1, n, 1, True), (2, n, 1, False), (3, 0, 3, True), (4, 0, 4, True)} <= odd
    kept = neardup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 1").count() == 1 and kept.where("doc_id = 2").count() == 0
    assert neardup.near_duplicates(no_docs).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (40, 60)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 40: 40, 50: 40, 60: 40}
    stars = spark.createDataFrame([(1, 2), (1, 3), (1, 3), (9, 8), (5, 5)], "a bigint, b bigint")
    assert {tuple(r) for r in components(stars).collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)}
    assert components(stars.limit(0)).count() == 0


def test_decontamination(spark, odd_docs, no_docs):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(12)] + [(99, None), (98, "")]
    filler = lambda n: " ".join(word() for _ in range(n))
    docs = [(i, f"{filler(40)} {items[i][1]} {filler(40)}") for i in range(12)] + [(100 + i, filler(90)) for i in range(30)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = decontam.searcher(docs, bench)
    got = {r["doc_id"]: r["items"] for r in decontam.contaminated(docs, found).collect() if r["contaminated"]}
    assert got == {i: [i] for i in range(12)}
    assert decontam.contaminated(odd_docs, found).count() == odd_docs.count()
    none = decontam.searcher(odd_docs, bench.limit(0))
    assert decontam.keep_clean(odd_docs, none).count() == odd_docs.count()
    assert decontam.contaminated(no_docs, decontam.searcher(no_docs, bench)).count() == 0


def test_decontamination_of_short_items(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    filler = lambda n: " ".join(word() for _ in range(n))
    sizes = [1, 2, 3, 4, 5, 6, 7, 11, 15]
    texts = {m: [word() for _ in range(m)] for m in sizes}
    items = [(m, " ".join(w)) for m, w in texts.items()] + [(50, f"{texts[3][0]} - {texts[5][0]} ."), (60, filler(30))]
    docs = [(m, f"{filler(43)} {' '.join(w).upper()}, {filler(43)}") for m, w in texts.items()]
    docs += [(50, f"{filler(20)} {items[-2][1]} {filler(20)}")]
    docs += [(100 + m, f"{filler(20)} {' '.join(reversed(w))} {filler(20)}") for m, w in texts.items() if m > 1]
    docs += [(201, " ".join(texts[7][:3] + [word()] + texts[7][4:]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r["doc_id"]: r["items"] for r in decontam.contaminated(docs, decontam.searcher(docs, bench)).collect() if r["contaminated"]}
    assert got == {**{m: [m] for m in sizes}, 50: [50], 201: [7]}


def test_mixing(spark, odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rows)
    assert sum({r["source_size"]: r["target"] for r in rows}.values()) <= 1.5 * sum(r["size"] for r in rows) + 1e-6
    assert mixing.mix(no_docs).count() == 0


def test_class_scores(spark, odd_docs, no_docs):
    rows = classlm.class_scores(odd_docs).collect()
    docs = odd_docs.select("doc_id", "text").collect()
    lower = lambda t: t.translate({i: i + 32 for i in range(65, 91)})
    tokens = lambda t: [*WORD.findall(lower(t or "")), "\n"]
    count = Counter(w for d in docs if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 10 for w in tokens(d["text"]))
    n, v = sum(count.values()), len(count)
    want = sorted(round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(d["text"])), 6) for d in docs)
    assert np.allclose(sorted(r["base_score"] for r in rows), want) and {r["train_tokens"] for r in rows} == {n}
    assert all(r["score"] < 0 for r in rows)
    assert classlm.class_scores(no_docs).count() == 0


def test_exchange_finds_planted_classes():
    pairs = np.zeros((13, 13))
    for a in range(12):
        for b in range(12):
            pairs[a, b] = 50 if (a % 2) != (b % 2) else 1
    group = classlm.exchange(pairs, 0, 2, 10)
    assert len(set(group[0:12:2])) == 1 and len(set(group[1:12:2])) == 1 and group[0] != group[1]


def test_repeated_passages(spark, odd_docs, no_docs, monkeypatch):
    rng = random.Random(3)
    shared = [f"s{i}" for i in range(50)]
    texts = [(i, " ".join([f"a{rng.randrange(4)}" for _ in range(80)] + (shared[rng.randrange(9):] if i % 3 else []) + ["z"] * (40 * (i % 2)))) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    seen = Counter(tuple(t.split()[i:i + 35]) for _, t in texts for i in range(len(t.split()) - 34))
    for local in (4096, 1):
        monkeypatch.setattr(substrings, "LOCAL", local)
        got = {r["doc_id"]: (r["n_words"], r["text"]) for r in substrings.remove_repeats(docs, keep_text=True).collect()}
        for i, t in texts:
            w = t.split()
            gone = {j for s in range(len(w) - 34) if seen[tuple(w[s:s + 35])] > 1 for j in range(s, s + 35)}
            assert got[i] == (len(w), " ".join(x for j, x in enumerate(w) if j not in gone))
    assert substrings.remove_repeats(odd_docs).count() == odd_docs.count()
    assert substrings.remove_repeats(no_docs).count() == 0


def test_repeated_passages_compares_whole_fingerprints(spark, monkeypatch):
    # two different windows of one anchor whose fingerprints agree in their upper 32 bits
    texts = [" ".join([f"w{i}" for i in range(33)] + tail) for tail in (["a414", "b312"], ["a838", "b859"])]
    b = substrings.blocks(word_hashes([w.encode() for t in texts for w in t.split()]), np.array([35, 35]))
    upper = b["windows"].astype(np.uint64) >> np.uint64(32)
    assert b["anchor"][0] == b["anchor"][1] and upper[0] == upper[1]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for local in (4096, 1):
        monkeypatch.setattr(substrings, "LOCAL", local)
        assert {r["n_removed"] for r in substrings.remove_repeats(docs).collect()} == {0}


def test_licences(spark, odd_docs, no_docs):
    docs = spark.createDataFrame(
        [(1, "Foo bar.\nReleased under the MIT License.\nMore text."), (2, "This work is licensed under the GNU General Public License, version 3."),
         (3, "the public may license this or that to whoever it likes best of all these days"), (4, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["licences"], r["places"]) for r in licences.scan(docs.unionByName(odd_docs.select("doc_id", "text").where("doc_id > 4"))).collect()}
    assert got[1] == ("mit", "mit:2") and got[2][0] == "gpl" and got[3][0] == "" and got[4] == ("", "")
    assert licences.scan(no_docs).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 16)).astype("f4")
    x[100:160] = x[100]  # many equal vectors
    rows = [(i, x[i].tolist(), "e") for i in range(1500)] + [(2000, None, "e"), (2001, [0.0] * 16, "e"), (2002, [float("nan")] + [1.0] * 15, "e"), (2003, [None] + [1.0] * 15, "e")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, node string")
    out = ann.nearest(table, F.col("vec_id") % 20 == 0, rounds=2).collect()
    s = x.astype("f8") @ x.astype("f8").T
    hits = 0
    for q in range(0, 1500, 20):
        order = sorted((j for j in range(1500) if j != q), key=lambda j: (-s[q, j], j))[:20]
        mine = [r["vec_id"] for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])]
        assert len(mine) == 20
        hits += len(set(mine) & set(order))
    assert hits >= 0.9 * 20 * 75
    assert ann.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_nearest_goes_on_until_nothing_changes(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 8)  # the start graph alone is poor
    x = np.random.default_rng(6).standard_normal((3000, 12)).astype("f4")
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    out = ann.nearest(table, F.col("vec_id") % 30 == 0, degree=40, trees=3, rounds=1, turns=0).collect()
    s = x.astype("f8") @ x.astype("f8").T
    np.fill_diagonal(s, -np.inf)
    hits = sum(r["vec_id"] in np.argsort(-s[r["query_id"]])[:20] for r in out)
    assert hits >= 0.9 * 20 * 100


def test_nearest_with_lengths_over_several_powers_of_ten(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 32)
    monkeypatch.setattr(ann, "BLOCK", 256)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 16))
    one_long, spread = x.copy(), x * 10.0 ** rng.uniform(-4, 4, 3000)[:, None]
    one_long[77] *= 1e4
    for y in (one_long, spread, x / np.linalg.norm(x, axis=1)[:, None]):
        table = spark.createDataFrame([(i, v.tolist(), None) for i, v in enumerate(y)], "vec_id bigint, embedding array<double>, band string")
        out = ann.nearest(table, F.col("vec_id") % 30 == 0).collect()
        s = y @ y.T
        np.fill_diagonal(s, -np.inf)
        assert len(out) == 100 * 20
        hits = sum(r["vec_id"] in np.argsort(-s[r["query_id"]])[:20] for r in out)
        assert hits >= 0.95 * 20 * 100


def test_nearest_leaves_odd_vectors_out(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 9)] + [
        (20, None), (21, []), (22, [0.0, 0.0]), (23, [float("inf"), 1.0]), (24, [None, 1.0]), (25, [1.0]), (None, [5.0, 5.0]), (3, [3.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    out = ann.nearest(table, F.lit(True)).collect()
    assert {r["query_id"] for r in out} == {r["vec_id"] for r in out} == set(range(1, 9))
    assert len(out) == 8 * 7
    assert [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == 4] == [8, 7, 6, 5, 3, 2, 1]
