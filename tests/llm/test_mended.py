"""Cases that once failed: odd batches, long digits and secrets, ids with several texts, long texts."""

import random
import resource

import numpy as np
import pyarrow as pa
import pytest

from loamgrid.llm import ann, decontam, language, neardup, pii

from .conftest import WORDS


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_a_batch_without_any_word_of_a_short_item(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string")
    docs = frame(spark, [(1, "nothing of it here"), (2, ""), (3, None)]).coalesce(1)
    found = decontam.searcher(docs, bench)
    assert [r["contaminated"] for r in decontam.contaminated(docs, found).collect()] == [False] * 3
    assert decontam.keep_clean(docs, found).count() == 3
    hit = frame(spark, [(4, "so alpha beta gamma it is"), (5, None)])
    assert {r["doc_id"]: r["contaminated"] for r in decontam.contaminated(hit, found).collect()} == {4: True, 5: False}


def test_the_latent_space_hangs_on_no_draw_of_documents(spark):
    """Texts that differ in punctuation alone have the same words, and a hash of them would draw others."""
    rng = random.Random(5)
    known = [f"{a}{b}" for a in WORDS[:20] for b in WORDS[20:]]  # more terms than the space has dimensions
    bench = spark.createDataFrame([(i, " ".join(rng.sample(known, 20))) for i in range(30)], "item_id bigint, text string")
    texts = [" ".join(rng.choices(known, k=24)) for _ in range(1500)]
    plain, dotted = (decontam.searcher(frame(spark, [(i, t + end) for i, t in enumerate(texts)]), bench) for end in ("", "."))
    cosines = [f.passages @ f.passages.T for f in (plain, dotted)]
    assert np.allclose(plain.idf, dotted.idf) and np.allclose(*cosines, atol=1e-4)


def test_very_long_numbers_are_addresses_by_value(spark):
    zeros, ones = "0" * 5000 + "1.2.3.4", "1" * 5000 + ".2.3.4"
    rows = pii.personal_data(frame(spark, [(1, zeros), (2, ones)])).collect()
    assert {r["doc_id"]: r["n_ip"] for r in rows} == {1: 1, 2: 0}


@pytest.mark.parametrize("n", [20, 120, 5000])
def test_secrets_of_any_length_are_redacted_whole(spark, n):
    rng = random.Random(n)
    key = "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGH23456789") for _ in range(n))
    rows = [(i, f"login api_key = {key} ok") for i in range(5)] + [(9, "plain words, no key at all")]
    clean = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, rows)).collect()}
    assert clean[0] == "login api_key = <SECRET> ok" and clean[9] == rows[-1][1]


def test_overlaps_of_many_strict_spans():
    rng = random.Random(2)
    for _ in range(300):
        spans = sorted((a := rng.randrange(60), a + rng.randint(1, 30)) for _ in range(rng.randint(0, 20)))
        ends = list(np.maximum.accumulate([b for _, b in spans])) if spans else []
        start = rng.randrange(60)
        end = start + rng.randint(1, 10)
        assert pii._overlaps([a for a, _ in spans], ends, start, end) == any(a < end and b > start for a, b in spans)


def test_an_id_with_two_texts_links_both(spark):
    a, b = " ".join(WORDS), " ".join(reversed(WORDS))
    docs = frame(spark, [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, "quite another text of several words")])
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, width=3, percent=(85, 100)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}
    assert sorted(r["doc_id"] for r in neardup.keep_one(docs, width=3, percent=(85, 100)).collect()) == [1, 4]


def brute_nearest(text, profiles):
    """Plain counts and ranks: language of least out-of-place distance, and score."""
    from collections import Counter

    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    none = 0x1FFFFF
    counts = Counter()
    for w in words:
        c = [0, *map(ord, w), 0]
        counts.update(none << 42 | none << 21 | x for x in c[1:-1])
        counts.update(none << 42 | x << 21 | y for x, y in zip(c, c[1:], strict=False))
        counts.update(x << 42 | y << 21 | z for x, y, z in zip(c, c[1:], c[2:], strict=False))
    mine = sorted(counts, key=lambda g: (-counts[g], g))[:language.SIZE]
    if not mine or not profiles:
        return counts, "und", 0.0
    far = {k: sum(abs(i + 1 - p[g]) if g in p else language.SIZE for i, g in enumerate(mine)) for k, p in profiles.items()}
    best = min(sorted(far), key=far.get)
    return counts, best, 1 - far[best] / (language.SIZE * len(mine))


def test_language_equals_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(language, "PIECE", 64)
    rng = random.Random(7)
    letters = {"aa": "aeioutnsr", "bb": "qwkzxyvbj", "cc": "éàüößçñœï", "dd": "мнопрстуе"}
    rows = []
    for i in range(120):
        lang = rng.choice([*letters, None])
        text = " ".join("".join(rng.choice(letters[lang or "aa"]) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 120)))
        rows.append((i, text.capitalize() + rng.choice(["", "!", " -- 12"]), lang))
    rows += [(200, None, "aa"), (201, "x" * 300, "bb"), (202, "İstanbul Σίσυφος", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    from pyspark.sql import functions as F

    known = language.profiles(docs, F.col("doc_id") < 100)
    totals = {}
    for i, text, lang in rows:
        if i < 100 and lang is not None:
            totals.setdefault(lang, []).append(brute_nearest(text, {})[0])
    profiles = {}
    for lang, parts in totals.items():
        n = sum(parts[1:], parts[0])
        profiles[lang] = {g: r + 1 for r, g in enumerate(sorted(n, key=lambda g: (-n[g], g))[:language.SIZE])}
    for r in language.identify(docs, known).collect():
        text = next(t for i, t, _ in rows if i == r["doc_id"])
        _, lang, score = brute_nearest(text, profiles)
        assert (r["lang_pred"], round(r["score"], 12)) == (lang, round(score, 12)), r


def test_a_long_text_is_counted_in_little_memory():
    text = "some ordinary words, again and again; " * 1_300_000  # 49 MB
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    tally = language.Tally()
    tally.add(text)
    tally.merge()
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 250
    assert len(tally.codes) > 50 and tally.n.max() > 1_300_000


def test_no_machine_local_folder_on_a_cluster(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master, applicationId = "spark://host:7077", "app"

    from loamgrid.llm.common import scratch

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch(Cluster)
    assert scratch(spark)


def test_documents_with_a_common_line_meet_by_their_rare_shingles(spark, monkeypatch):
    """Such a line puts unlike documents into one cluster, which must not be compared all with all."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    line = [word() for _ in range(60)]
    texts = [line + [word() for _ in range(30)] for _ in range(150)]
    for t in texts[:12]:  # copies with a word changed
        for at in (70, 85):
            texts.append([*t[:at], word(), *t[at + 1:]])
    sets = [{tuple(t[i:i + 3]) for i in range(len(t) - 2)} for t in texts]
    part = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                part = [min(part[i], part[j]) if p in (part[i], part[j]) else p for p in part]
    monkeypatch.setattr(neardup, "SMALL", 8)
    clustered, blocked = [], []
    plain, meet = neardup._block_requests, neardup._meetings
    monkeypatch.setattr(neardup, "_block_requests", lambda members: blocked.append(members.count()) or plain(members))
    monkeypatch.setattr(neardup, "_meetings", lambda members, *more: clustered.append(members.count()) or meet(members, *more))
    docs = frame(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, width=3, percent=(85, 100)).collect()}
    assert got == dict(enumerate(part)) and len(set(part)) == 150
    assert clustered[0] > 100 and blocked == [0]


def test_a_block_of_the_graph_needs_a_bounded_number_of_vectors(spark, monkeypatch):
    """A node brings its neighbours' vectors along, so with many nodes to choose from blocks get smaller."""
    rng = np.random.default_rng(4)
    nodes = spark.createDataFrame([(i, 0, rng.standard_normal(9).astype(np.float32).tobytes()) for i in range(3000)], "node bigint, band int, x binary")
    biggest = lambda k: ann.placed(nodes, 9, 3000, k).groupBy("block").count().agg({"count": "max"}).first()[0]
    assert biggest(6) > 2000
    monkeypatch.setattr(ann, "NEED", 1000)
    assert 10 * biggest(6) <= 1.5 * 1000


def test_lists_are_read_where_arrow_holds_them():
    lists = [b"", None, np.arange(3).tobytes(), np.arange(9, 5, -1).tobytes(), None, b"x" * 8]
    whole = pa.array(lists, pa.binary())
    for column in (whole, pa.chunked_array([whole[:2], whole[2:2], whole[2:]]), pa.chunked_array([], pa.binary())):
        values, sizes = ann._flat(column, np.int64)
        assert sizes.tolist() == [len(x or b"") // 8 for x in lists][:len(column)]
        assert values.tobytes() == b"".join(x or b"" for x in lists[:len(column)])
    part = whole[3:5]  # begins within its buffer
    assert ann._flat(part, np.int64)[0].tolist() == [9, 8, 7, 6]
    x = np.arange(6, dtype=np.float32)
    base = ann._flat(pa.chunked_array([ann._cut(x, np.array([3, 3]))]), np.float32)[0]
    assert not base.flags.owndata  # no copy
