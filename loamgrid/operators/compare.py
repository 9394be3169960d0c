"""Stored pixels against the tables they came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import close_enough
from ..model.intervals import DEPTH, LABELS
from ..model.variables import Variable
from ..sources.pixels import CELL, mapped
from .lookup import single, skew_safe_join

UNDERSAMPLED = "insufficient sampling"


def key_differences(stored: DataFrame, source: DataFrame) -> DataFrame:
    """Cells whose key differs between two pixel tables, in either direction."""
    a = mapped(stored).select(*CELL, F.col("mukey").alias("stored_mukey"))
    b = mapped(source).select(*CELL, F.col("mukey").alias("source_mukey"))
    return a.join(b, list(CELL), "full").where(~F.col("stored_mukey").eqNullSafe(F.col("source_mukey")))


def key_equality(stored: DataFrame, source: DataFrame, regions: DataFrame) -> DataFrame:
    """Compared cells and mismatches of every region asked for; nothing compared is a failure."""
    a = mapped(stored).select(*CELL, F.col("mukey").alias("stored_mukey"))
    b = mapped(source).select(*CELL, F.col("mukey").alias("source_mukey"))
    counts = a.join(b, list(CELL), "full").groupBy("region").agg(
        F.count("*").alias("compared"),
        F.count_if(~F.col("stored_mukey").eqNullSafe(F.col("source_mukey"))).alias("mismatches"),
    )
    zero = F.lit(0).cast("long")
    out = regions.select("region").join(counts, "region", "left").select(
        "region", F.coalesce("compared", zero).alias("compared"), F.coalesce("mismatches", zero).alias("mismatches")
    )
    return out.select("*", verdict("compared", "mismatches")).withColumn("passed", F.col("status") == "passed")


def value_comparison(
    stored: DataFrame, values: DataFrame, v: Variable, *, rows: int | None = None, hot: Sequence = (),
) -> DataFrame:
    """Each stored cell beside its table value, with the verdict.

    A missing table value must appear as the fill value, a float one as missing.
    A product with depth is compared interval by interval; repeated keys are refused.
    """
    value, kind = F.col(v.name).cast("double"), T.DoubleType()
    if v.fill is not None:
        value = F.nanvl(value, F.lit(None).cast("double"))
    keyed = values.where(F.col("mukey").isNotNull()).groupBy("mukey")
    if v.by_depth:
        # all intervals of a map unit travel as one array, so no cell is shuffled by interval
        every = keyed.agg(F.array(*[single(value, F.col(DEPTH) == label, v.name, kind) for label in LABELS]).alias("every"))
        place = F.array_position(F.array(*[F.lit(label) for label in LABELS]), F.col(DEPTH)).cast("int")
        expected = F.when(place > 0, F.get("every", place - 1))
    else:
        every = keyed.agg(single(value, F.lit(True), v.name, kind).alias("every"))
        expected = F.col("every")
    pairs = skew_safe_join(stored, every, "mukey", rows=rows, hot=hot).withColumn("expected", expected).drop("every")
    if v.fill is None:
        same = close_enough("value", "expected")
    else:
        wanted = F.coalesce(F.bround("expected", 0), F.lit(float(v.fill)))
        same = F.coalesce(F.col("value").cast("double") == wanted, F.lit(False))
    return pairs.withColumn("same", same)


def value_equality(
    stored: DataFrame, values: DataFrame, v: Variable, *, rows: int | None = None, hot: Sequence = (),
) -> DataFrame:
    """One row: how many cells were compared, how many differ, and the verdict."""
    compared = value_comparison(stored, values, v, rows=rows, hot=hot)
    counts = compared.agg(F.count("*").alias("compared"), F.count_if(~F.col("same")).alias("mismatches"))
    return counts.select(F.lit(v.name).alias("variable"), "compared", "mismatches", verdict("compared", "mismatches"))


def verdict(compared: str, mismatches: str):
    """'passed', 'failed', or the undersampled mark when nothing was compared."""
    return (
        F.when(F.col(compared) == 0, F.lit(UNDERSAMPLED))
        .when(F.col(mismatches) == 0, F.lit("passed")).otherwise(F.lit("failed")).alias("status")
    )


def check_status(counts: DataFrame, *, source_available: bool = True) -> DataFrame:
    """Turn (check_name, compared, mismatches) rows into verdicts.

    A check that could not be asked for is skipped and passes; a check that ran
    over nothing fails.
    """
    if not source_available:
        return counts.select("check_name", "compared", "mismatches", F.lit("skipped").alias("status"), F.lit(True).alias("passed"))
    out = counts.select("check_name", "compared", "mismatches", verdict("compared", "mismatches"))
    return out.withColumn("passed", F.col("status") == "passed")
