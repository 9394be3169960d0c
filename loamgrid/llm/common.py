"""Helpers shared by the operators: input, shared scratch tables, hashes of words, connected components."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.session import tune

# functions travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules["loamgrid.llm"])

_OWN_SCRATCH: dict[str, str] = {}


def prepare(spark: SparkSession, batch_bytes: int = 16 << 20) -> None:
    """Settings of a live session the operators are written for."""
    # the operators deal out by keys of their own
    tune(spark, partitioning=False)
    # very long texts: bound what one Arrow batch holds, whatever its rows
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    # rounds are written and read back: what a finished one shuffled goes at once, not when the driver collects garbage
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name below the folder all executors share; an own one only where there is a single machine and none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        base = _OWN_SCRATCH.setdefault(app, tempfile.mkdtemp(prefix="spark-llm-"))
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def store(df: DataFrame) -> DataFrame:
    """Cut lineage: write to the shared folder and read back."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Delete what ``store`` wrote, once nothing reads it any more."""
    spark = stored.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in stored.inputFiles()}:
        if folder.rsplit("/", 1)[1].startswith("llm-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def text_key(text: str = "text") -> Column:
    """With the id, what tells one row from another when a later step needs its text again."""
    return F.xxhash64(F.col(text))


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Texts as UTF-8; null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def batches(rows: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes of text each (a longer single row is a slice of its own)."""
    for batch in rows:
        step = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _stars(edges: DataFrame) -> bool:
    """Whether every u has one edge and no v is a u of another."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (a, b); ids without links don't appear.

    Alternating large-star and small-star steps, until every id hangs on the
    smallest of its component; every step is an aggregate with map-side
    combination and a join, and every round is written and read back.
    """
    edges = store(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u")
        edges = store(
            pairs.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
    tops = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        tops.select("id", F.col("id").alias("component"))
    )
