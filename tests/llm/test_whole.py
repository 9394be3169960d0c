"""Findings of the third round: whole corpora, bounded memory."""

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from loamgrid.llm import common, licences, substrings


def test_licences_learn_from_every_line(spark):
    """1,200 lines, far more than were once drawn, some of them alike, blank, or a licence themselves."""
    texts = [f"word{i} of the license\n\nplain{i % 7}\nReleased under the MIT License." for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    known, rest, vocabulary = licences.training(docs)
    assert rest.agg(F.sum("n")).first()[0] == 1200
    assert {tuple(r["grams"]): r["n"] for r in rest.collect()} == {("license", "of", "of the", "of the license", "the", "the license"): 600, (): 600}
    assert {"license", "the license"} <= set(vocabulary) and known.where("family = 'mit'").count() > 0


def test_covers_are_counted_only_for_lines_with_an_anchor(spark):
    """Every part of every template, with other words: the same lines as when all are counted, few of them counted."""
    rows = licences.templates(spark.range(0)).collect()
    some = {w for r in rows for w in r["words"]}
    parts = [r["words"][i:j] + [f"other{i}"] for r in rows for i in range(len(r["words"])) for j in range(i, len(r["words"]) + 1)]
    parts += [[], ["the", "of", "this"], sorted(some), sorted(some - set(licences.anchors(rows)))]
    held = spark.createDataFrame([(p,) for p in parts], "grams array<string>")
    got = [(set(r["grams"]), r["c"]) for r in held.select("grams", licences.covers(rows).alias("c")).collect()]
    assert len(got) == len(parts)
    assert all(c == any(len(g & set(r["words"])) / len(r["words"]) >= licences.COVER for r in rows) for g, c in got)
    assert "arrays_overlap" in str(licences.covers(rows))


def test_spans_found_before_the_shuffle_are_put_out_batch_by_batch():
    """Copies marked at once must not wait in a task's memory until the last batch."""
    columns = ["doc_id", "key", "lo", "n", "anchor", "block", "copies", "windows"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    taken = []

    def rows():
        for i in range(6):
            taken.append(i)
            values = [[i] * 50, [i] * 50, list(range(50)), [1] * 50, [7] * 50, [9] * 50, [0] * 50, [None] * 50]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], columns)

    seen, most = 0, 0
    for out in substrings._split(rows()):
        seen += out.num_rows
        most = max(most, out.num_rows)
    assert len(taken) == 6 and seen == 300 and most == 50


def test_stages_bound_their_batches_on_any_session(spark):
    """A stage called alone, on a session nothing was read through, must not hand Python workers batches of any size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame(
        [(i, "the quick brown fox jumps over the lazy dog", "en", "web", 43) for i in range(20)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    try:
        for name, stage in corpus_pipeline.STAGES:
            if name != "decontamination":
                spark.conf.set(key, str(256 << 20))
                stage(spark, docs, "")
                assert int(spark.conf.get(key)) == corpus_pipeline.BATCH, name
    finally:
        spark.conf.set(key, before)


def test_what_a_finished_round_shuffled_is_deleted(spark):
    common.prepare(spark)
    stored = common.store(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    pairs = stored.groupBy("count").agg(F.count("*").alias("n"))
    assert pairs.collect() == pairs.collect() and stored.count() == 7
