"""A training-data pipeline over ``documents``: five stages, each written and read back before the next.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns the columns of documents; the last returns the mix.  The stages
check against brute-force versions in ``tests/llm``; no SQL expresses them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm import decontam, language, mixing, neardup, pii
from loamgrid.llm.common import prepare, read, remainder, store

#: A document whose profile is further from every language than this is no text of a known one.
LEAST_LANGUAGE_SCORE = 0.2
#: Bytes of an Arrow batch: a stage may be called on any session, and its Python workers hold a batch each way.
BATCH = 2 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or far from every language's profile, go."""
    prepare(spark, BATCH)
    known = language.profiles(docs, remainder(F.col("doc_id"), 3) != 1)
    return language.keep_identified(docs, known, LEAST_LANGUAGE_SCORE)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the one with the smallest id stays."""
    prepare(spark, BATCH)
    return neardup.keep_one(docs, width=5, percent=(80, 100))


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    benchmark = read(spark, sf_dir, "benchmark")
    prepare(spark, BATCH)
    return decontam.keep_clean(docs, decontam.searcher(docs, benchmark))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind; no document goes."""
    prepare(spark, BATCH)
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    prepare(spark, BATCH)
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark_leaks),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
