"""What has been written: an append-only table of tile and completion events.

A *pair* is one product in one region.  Every attempt at a pair has a run
number.  A run is recorded when it begins, tiles as they are published, the pair
when all of them are.  Nothing is ever updated in place: the state of a pair is an aggregate over
its events, so a lost or repeated append never corrupts it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIR = ["region", "variable"]
RUN_BEGUN, TILE_DONE, PAIR_DONE = "begin", "tile", "complete"

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("variable", T.StringType()),
        T.StructField("run_no", T.IntegerType()),
        T.StructField("event", T.StringType()),
        T.StructField("tile_y", T.IntegerType()),
        T.StructField("tile_x", T.IntegerType()),
        T.StructField("tile_size", T.IntegerType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("algorithm_id", T.StringType()),
        T.StructField("algorithm_version", T.StringType()),
        T.StructField("tiles_written", T.LongType()),
        T.StructField("unmatched_mukey_count", T.LongType()),
        T.StructField("values_fingerprint", T.StringType()),
        T.StructField("tiles_skipped", T.LongType()),
    ]
)


class IncompleteError(RuntimeError):
    """A release was asked for while pairs are missing."""


def not_written_yet(error: AnalysisException) -> bool:
    """Whether a read failed for want of the path; any other failure must surface."""
    return error.getCondition() == "PATH_NOT_FOUND"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty before the first append."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as error:
        if not not_written_yet(error):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def append(ledger: DataFrame, path: str) -> None:
    have = set(ledger.columns)
    full = ledger.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA]
    )
    full.write.mode("append").parquet(path)


def pair_state(ledger: DataFrame) -> DataFrame:
    """Latest run of each pair and whether it finished.

    A newer unfinished run outranks an older finished one: the pair is being
    rewritten and owes the rest of its tiles.
    """
    finished = F.max(F.when(F.col("event") == PAIR_DONE, F.col("run_no")))
    latest = F.max("run_no")
    return ledger.groupBy(*PAIR).agg(latest.alias("run_no"), finished.alias("finished_run")).select(
        *PAIR, "run_no", F.coalesce(F.col("finished_run") == F.col("run_no"), F.lit(False)).alias("complete")
    )


def finished_runs(ledger: DataFrame) -> DataFrame:
    """The latest finished run of each pair: the one whose cells are read."""
    return ledger.where(F.col("event") == PAIR_DONE).groupBy(*PAIR).agg(F.max("run_no").alias("run_no"))


def snapshot(ledger: DataFrame, regions: DataFrame, variables: Sequence[str]) -> DataFrame:
    """What a release pins: the run of each region and product that holds its current cells."""
    return wanted_pairs(regions, variables).join(finished_runs(ledger), PAIR)


def as_of(cells: DataFrame, pins: DataFrame, tag: str | None = None) -> DataFrame:
    """Cells (region, variable, run_no, ...) of the runs that a tag pins, or of every tag, marked with it."""
    chosen = pins.select("tag", *PAIR, "run_no")
    if tag is not None:
        chosen = chosen.where(F.col("tag") == tag)
    return cells.join(chosen, [*PAIR, "run_no"])


def same_work(ledger: DataFrame, run_no: int, tile_size: int, release_date: str, fingerprint: str) -> bool:
    """Whether a run of one pair began with this grid, release and value table, so that it may be continued."""
    wanted = {"tile_size": tile_size, "release_date": release_date, "values_fingerprint": fingerprint}
    begun = ledger.where((F.col("run_no") == run_no) & (F.col("event") == RUN_BEGUN)).agg(
        F.count("*").alias("n"), F.count_if(~_all([F.col(c).eqNullSafe(F.lit(x)) for c, x in wanted.items()])).alias("other")
    ).first()
    return begun["n"] > 0 and begun["other"] == 0


def _all(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def remaining_pairs(regions: DataFrame, variables: Sequence[str], ledger: DataFrame) -> DataFrame:
    """Pairs that are still owed; a pair in flight counts as owed.

    ``variables`` are the names of the products, a fixed list of the registry.
    """
    done = pair_state(ledger).where("complete").select(*PAIR)
    return wanted_pairs(regions, variables).join(done, PAIR, "left_anti")


def wanted_pairs(regions: DataFrame, variables: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(name) for name in variables]).cast("array<string>")
    return regions.select("region", F.explode(names).alias("variable"))


def completion_matrix(regions: DataFrame, variables: Sequence[str], ledger: DataFrame) -> DataFrame:
    """Per region: pairs wanted and done, the state and what is missing."""
    state = pair_state(ledger)
    joined = wanted_pairs(regions, variables).join(state, PAIR, "left")
    done = F.coalesce(F.col("complete"), F.lit(False))
    in_flight = F.col("run_no").isNotNull() & ~done
    counts = joined.groupBy("region").agg(
        F.count("*").alias("wanted"), F.count_if(done).alias("done"), F.count_if(in_flight).alias("in_flight"),
        F.array_join(F.sort_array(F.collect_list(F.when(~done, F.col("variable")))), ", ").alias("missing"),
    )
    state_text = (
        F.when(F.col("done") == F.col("wanted"), F.lit("complete"))
        .when((F.col("done") == 0) & (F.col("in_flight") == 0), F.lit("not started"))
        .otherwise(F.concat_ws("/", F.col("done").cast("string"), F.col("wanted").cast("string")))
    )
    return counts.select("region", "wanted", "done", "in_flight", state_text.alias("state"), "missing")


def owed_tiles(tiles: DataFrame, ledger: DataFrame, tile_size: int) -> DataFrame:
    """Tiles of the given pairs that the current run has not published.

    Records of another tile size describe another grid and are ignored, so such
    a pair starts over.
    """
    state = pair_state(ledger).where(~F.col("complete")).select(*PAIR, "run_no")
    published = (
        ledger.where((F.col("event") == TILE_DONE) & (F.col("tile_size") == tile_size))
        .join(state, [*PAIR, "run_no"], "left_semi")
        .select(*PAIR, "tile_y", "tile_x")
    )
    return tiles.join(published, [*PAIR, "tile_y", "tile_x"], "left_anti")


def release_gate(regions: DataFrame, variables: Sequence[str], ledger: DataFrame) -> DataFrame:
    """One row: pairs missing, whether a release may be made."""
    return remaining_pairs(regions, variables, ledger).agg(F.count("*").alias("missing_pairs")).withColumn(
        "passed", F.col("missing_pairs") == 0
    )


def require_complete(regions: DataFrame, variables: Sequence[str], ledger: DataFrame) -> None:
    missing = remaining_pairs(regions, variables, ledger).count()
    if missing:
        raise IncompleteError(f"{missing} pairs missing; remaining_pairs lists them")


def provenance(ledger: DataFrame) -> DataFrame:
    """The record of the latest finished run of each pair; of equal runs the largest record, field by field."""
    columns: Sequence[str] = (
        "run_no", "release_date", "algorithm_id", "algorithm_version", "tile_size", "tiles_written",
        "unmatched_mukey_count", "tiles_skipped",
    )
    return (
        ledger.where(F.col("event") == PAIR_DONE).groupBy(*PAIR)
        .agg(F.max(F.struct(*columns)).alias("r")).select(*PAIR, "r.*")
    )
