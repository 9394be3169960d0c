"""The five stages in their order against plain Python versions, each on what its predecessor kept."""

import random
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from loamgrid.llm import language
from loamgrid.llm.queries import MIX_SQL

from .test_mended import brute_nearest

duckdb = pytest.importorskip("duckdb")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LETTERS = {"aa": "aeioutnsrl", "bb": "qwkzxyvbjg", "cc": "éàüößçñœïê", "dd": "мнопрстуеа"}


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    rng = random.Random(19)

    def prose(lang, n):
        return ["".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(3, 7))) for _ in range(n)]

    items = [(i, " ".join("".join(rng.choice("hdcmpf") for _ in range(6)) for _ in range(24))) for i in range(4)]
    rows = []
    for i in range(200):
        lang = rng.choice(list(LETTERS))
        words = prose(lang, rng.randint(60, 140))
        if i % 9 == 4:
            words[10:10] = items[i % 4][1].split()
        if i % 7 == 3:
            words.insert(3, f"{rng.choice('abc')}name{i}@mail{i % 5}.example.com")
        text = " ".join(words)
        if i % 10 == 8:  # a near copy of an earlier document
            old = rng.choice(rows)[1].split()
            old[len(old) // 2] = "changed"
            text = " ".join(old)
        if i % 25 == 13:
            text = rng.choice(["", "12 34 -- 5", None])
        rows.append((i, text, None if i % 11 == 5 else lang, rng.choice(["web", "web", "web", "book", None]), None))
    rows.append(rows[17])
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def plain_language(rows, _):
    learned = {}
    for i, text, lang, *_r in rows:
        if lang is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            learned.setdefault(lang, Counter()).update(brute_nearest(text, {})[0])
    profiles = {k: {g: r + 1 for r, g in enumerate(sorted(n, key=lambda g: (-n[g], g))[:language.SIZE])} for k, n in learned.items()}
    out = []
    for row in rows:
        _, lang, score = brute_nearest(row[1], profiles)
        if lang != "und" and score >= corpus_pipeline.LEAST_LANGUAGE_SCORE:
            out.append(row)
    return out


def plain_near(rows, _):
    sets = {}
    for i, text, *_r in rows:
        w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {" ".join(w[a:a + 5]) for a in range(len(w) - 4)} if len(w) >= 5 else ({" ".join(w)} if w else set())
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    seen, out = set(), []
    for row in rows:
        if find(row[0]) == row[0] and row[0] not in seen:
            seen.add(row[0])
            out.append(row)
    return out


def plain_clean(rows, items):
    return [r for r in rows if not any(t in (r[1] or "") for _, t in items)]


def plain_redact(rows, _):
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    clean = [(r[0], mail.sub("<EMAIL>", r[1]), *r[2:4]) for r in rows]
    return [(*r, len(r[1])) for r in clean]  # the length follows the text


PLAIN = {"language": plain_language, "near_duplicates": plain_near, "decontamination": plain_clean, "personal_data": plain_redact}


def test_stages_and_their_order(spark, inputs):
    path, rows, items = inputs
    docs = corpus_pipeline.read(spark, path, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == [*PLAIN, "mixing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = len(rows)
        docs = corpus_pipeline.store(stage(spark, docs, path))
        rows = PLAIN[name](rows, items)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert Counter(tuple(r) for r in docs.collect()) == Counter(rows), name
        assert len(rows) < before or name == "personal_data", name
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    rel = con.sql(MIX_SQL)
    want = [dict(zip(rel.columns, r, strict=True)) for r in rel.fetchall()]
    got = [r.asDict() for r in corpus_pipeline.run(spark, path).collect()]
    tidy = lambda rs: sorted((r["doc_id"], r["size"], r["source_size"], round(r["target"], 3), r["taken"]) for r in rs)
    assert tidy(got) == tidy(want)


def test_an_empty_table(spark, inputs, tmp_path):
    path, _, items = inputs
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
