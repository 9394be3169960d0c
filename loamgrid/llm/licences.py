"""Licence scan with DataFrame and SQL functions only.

Paragraphs (lines) are classified by sparse logistic regression over word 1- to
3-grams into licence families and ``unknown``, and a prediction counts only if
the paragraph covers enough of a template of its family.

* Fitting uses the templates below, each also with every word left out in turn,
  and for ``unknown`` every line of the corpus that covers no template.  Features
  are the grams of the templates; lines that hold the same ones are counted together
  and fitted as one row with that weight, which is the same as fitting each.  All
  lines together weigh as much as all forms of the templates.  The cut on the
  probability is calibrated on all these lines: of those taken for a licence no
  more than ``FALSE_RATE`` lie above it.
* A paragraph that covers ``COVER`` of a template has at least one of its anchor
  words (as many of its words as could not all be missing), so lines without any
  anchor are unknown without being scored.  This changes no result.

Defined cases: null or empty text has no paragraphs; a null id is passed through;
repeated rows give repeated rows; an empty corpus fits on templates alone; ties
of probability go to the family first by name; further columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, store

UNKNOWN = "unknown"
COVER = 0.6
FALSE_RATE = 0.01

# Lines by which public licences announce themselves.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright. No part of this publication may be reproduced without prior permission."),
]


def words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), r"[^\p{L}0-9.]+|\.(?![0-9])"), lambda w: w != "")


def grams(ws: Column) -> Column:
    pairs = F.zip_with(ws, F.slice(ws, 2, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    triples = F.zip_with(pairs, F.slice(ws, 3, 1 << 30), lambda a, b: F.concat(a, F.lit(" "), b))
    # zip_with pads the shorter side with null, and concat with null is null
    return F.filter(F.array_distinct(F.concat(ws, pairs, triples)), lambda g: g.isNotNull())


def templates(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame(TEMPLATES, "family string, line string").withColumn("words", F.array_distinct(words(F.col("line"))))


def anchors(rows: list) -> list[str]:
    """Of each template so many words that covering it without one of them is impossible, shared ones first."""
    use: dict[str, int] = {}
    for r in rows:
        for w in r["words"]:
            use[w] = use.get(w, 0) + len(w) // 4
    chosen: set[str] = set()
    for r in rows:
        spare = len(r["words"]) - math.ceil(COVER * len(r["words"]) - 1e-9)
        order = sorted(r["words"], key=lambda w: (w not in chosen, -use[w], -len(w), w))
        chosen.update(order[:spare + 1])
    return sorted(chosen)


def lines(docs: DataFrame) -> DataFrame:
    """row, doc_id and the words of the lines that cover a template, as (place from 1, words)."""
    rows = templates(docs).collect()
    stems = anchors(rows)
    forms = F.array(*[F.array(*[F.lit(w) for w in r["words"]]) for r in rows])

    def hit(p: Column) -> Column:
        test = F.contains(p["low"], F.lit(stems[0]))
        for s in stems[1:]:
            test = test | F.contains(p["low"], F.lit(s))
        return test

    split = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")
    numbered = F.transform(split, lambda line, i: F.struct((i + 1).alias("place"), line.alias("line"), F.lower(line).alias("low")))
    worded = F.transform(F.filter(numbered, hit), lambda p: F.struct(p["place"], words(p["line"]).alias("ws")))
    kept = F.filter(worded, lambda p: F.exists(forms, lambda form: F.size(F.array_intersect(form, p["ws"])) >= COVER * F.size(form)))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), kept.alias("lines"))


def line_features(docs: DataFrame, single: list[str]) -> DataFrame:
    """(grams, n): every non-empty line of the corpus as the grams it holds of the words ``single``, equal ones counted."""
    body = docs.select(F.explode(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")).alias("line")).where("line <> ''")
    # one empty word a line stays, so that lines without any other are counted too
    ws = body.select(F.monotonically_increasing_id().alias("line_no"), F.array_append(words(F.col("line")), F.lit("")).alias("ws"))
    wanted = docs.sparkSession.createDataFrame([(w,) for w in ["", *single]], "word string")
    met = ws.select("line_no", F.posexplode("ws").alias("at", "word")).join(F.broadcast(wanted), "word")
    held = met.groupBy("line_no").agg(F.sort_array(F.collect_list(F.when(F.col("word") != "", F.struct("at", "word")))).alias("ws"))
    pairs = F.zip_with("ws", F.slice("ws", 2, 1 << 30), lambda a, b: F.when(b["at"] == a["at"] + 1, F.concat(a["word"], F.lit(" "), b["word"])))
    held = held.select("ws", pairs.alias("pairs"))
    runs = F.zip_with("pairs", F.slice("pairs", 2, 1 << 30), lambda a, b: F.when(b.isNotNull(), a))
    triples = F.zip_with(runs, F.slice("ws", 3, 1 << 30), lambda a, c: F.concat(a, F.lit(" "), c["word"]))
    every = F.concat(F.transform("ws", lambda w: w["word"]), "pairs", triples)
    found = F.sort_array(F.array_distinct(F.array_compact(every)))
    return held.select(found.alias("grams")).groupBy("grams").agg(F.count("*").alias("n"))


def covers(rows: list) -> Column:
    """Whether ``grams`` cover a template; words are counted only where one of the anchors is among them."""
    forms = F.array(*[F.array(*[F.lit(w) for w in r["words"]]) for r in rows])
    anchored = F.arrays_overlap(F.col("grams"), F.array(*[F.lit(w) for w in anchors(rows)]))
    return F.when(anchored, F.exists(forms, lambda w: F.size(F.array_intersect(w, F.col("grams"))) / F.size(w) >= COVER)).otherwise(False)


def training(docs: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Forms of the templates (family, grams), all lines of the corpus that cover none (grams, n), and the grams counted."""
    t = templates(docs)
    ws = words(F.col("line"))
    without = F.transform(F.sequence(F.lit(0), F.size(ws)), lambda i: F.filter(ws, lambda w, j: j + 1 != i))
    known = store(t.select("family", F.explode(without).alias("w")).select("family", grams(F.col("w")).alias("grams")))
    forms = t.collect()
    single = sorted({w for r in forms for w in r["words"]})
    twice = known.select(F.explode("grams").alias("gram")).groupBy("gram").count().where("count > 1").collect()  # grams of the templates only
    vocabulary = sorted({*single, *(r["gram"] for r in twice)})
    # a line that covers a template is a licence, not an unknown; stored before, or the test would make the grams anew for every template
    features = store(line_features(docs, single))
    rest = store(features.where(~covers(forms)))
    discard(features)
    return known, rest, vocabulary


def fit(docs: DataFrame) -> tuple[DataFrame, list[str], float]:
    """Weights (gram, family, weight; '' is the bias), families, and the calibrated least probability."""
    known, rest, vocabulary = training(docs)
    total = rest.agg(F.sum("n")).first()[0]
    each = F.lit(known.count() / (total or 1))
    labelled = store(known.select("family", "grams", F.lit(1.0).alias("weight")).unionByName(
        rest.select(F.lit(UNKNOWN).alias("family"), "grams", (F.col("n") * each).alias("weight"))))
    vector = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="x").setBinary(True)
    index = StringIndexer(inputCol="family", outputCol="y", stringOrderType="alphabetAsc").fit(labelled)
    model = LogisticRegression(
        featuresCol="x", labelCol="y", weightCol="weight", regParam=0.002, maxIter=60, family="multinomial", standardization=False).fit(
        index.transform(vector.transform(labelled)))
    families = list(index.labels)
    table = model.coefficientMatrix.toArray()
    rows = [(g, f, float(table[i, j])) for j, g in enumerate(vocabulary) for i, f in enumerate(families)]
    rows += [("", f, float(b)) for f, b in zip(families, model.interceptVector.toArray(), strict=True)]
    weights = store(docs.sparkSession.createDataFrame(rows, "gram string, family string, weight double"))
    if not total:
        return weights, families, 0.5
    judged = model.transform(vector.transform(rest)).where(F.col("prediction") != families.index(UNKNOWN))
    # rounded up, so at most 10,000 values are counted
    chance = F.ceil(F.array_max(vector_to_array("probability")) * 10_000) / 10_000
    most = judged.select(chance.alias("chance"), "n").agg(F.percentile("chance", F.lit(1 - FALSE_RATE), F.col("n"))).first()[0]
    return weights, families, max(0.5, min(0.95, most or 0.5))


def classify(paragraphs: DataFrame, weights: DataFrame) -> DataFrame:
    """Most likely family of each (row, place, grams) and its probability."""
    parts = paragraphs.select("row", "place", F.explode(F.array_append("grams", F.lit(""))).alias("gram"))
    sums = parts.join(F.broadcast(weights), "gram").groupBy("row", "place", "family").agg(F.sum("weight").alias("z"))
    whole = Window.partitionBy("row", "place")
    soft = sums.withColumn("e", F.exp(F.col("z") - F.max("z").over(whole)))
    soft = soft.withColumn("chance", F.col("e") / F.sum("e").over(whole))
    return soft.groupBy("row", "place").agg(
        F.max_by("family", F.struct("chance", F.lit(0))).alias("family"), F.max("chance").alias("chance"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, licences (sorted families), n_paragraphs (confirmed), places (family:place), chance (highest) per row of ``docs``."""
    weights, _, least = fit(docs)
    held = store(lines(docs))
    paragraphs = held.select("row", F.inline("lines"))
    judged = classify(paragraphs.select("row", "place", grams(F.col("ws")).alias("grams")), weights)
    sure = judged.where((F.col("family") != UNKNOWN) & (F.col("chance") >= least))
    forms = templates(docs).select(F.col("family"), F.col("words").alias("form"))
    met = sure.join(paragraphs, ["row", "place"]).join(F.broadcast(forms), "family").where(
        F.size(F.array_intersect("form", "ws")) >= COVER * F.size("form"))
    confirmed = met.groupBy("row", "place", "family").agg(F.max("chance").alias("chance"))
    by_row = confirmed.groupBy("row").agg(
        F.array_sort(F.collect_set("family")).alias("licences"), F.count("*").alias("n_paragraphs"),
        F.array_sort(F.collect_list(F.struct("place", "family"))).alias("found"), F.max("chance").alias("chance"))
    places = F.array_join(F.transform("found", lambda p: F.concat_ws(":", p["family"], p["place"].cast("string"))), ",")
    return held.select("row", "doc_id").join(by_row, "row", "left").select(
        "doc_id", F.array_join("licences", ",").alias("licences"), F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"),
        places.alias("places"), "chance").select(
        "doc_id", F.coalesce("licences", F.lit("")).alias("licences"), "n_paragraphs", F.coalesce("places", F.lit("")).alias("places"), "chance")
