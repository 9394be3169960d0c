"""Counts that describe the pixel table and the source tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ratio
from .lookup import key_counts


def region_key_inventory(pixels: DataFrame) -> DataFrame:
    """Distinct keys, mapped pixels and key range per region."""
    return key_counts(pixels).groupBy("region").agg(
        F.count("*").alias("unique_mukeys"), F.sum("pixels").alias("mapped_pixels"),
        F.min("mukey").alias("min_mukey"), F.max("mukey").alias("max_mukey"),
    )


def source_class_inventory(areas: DataFrame, area_pixels: DataFrame) -> DataFrame:
    """Survey-area records and pixels per region and source class.

    ``areas`` has (area, source); ``area_pixels`` one row per pixel with
    (region, area).  Pixels are counted per area before the classes are joined.
    """
    counted = area_pixels.groupBy("region", "area").agg(F.count("*").alias("pixels"))
    return counted.join(areas, "area").groupBy("region", "source").agg(
        F.count("*").alias("survey_area_records"), F.sum("pixels").alias("pixels")
    )


def column_coverage(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Share of distinct keys with a value, per column, from one pass over the table."""
    per_key = df.groupBy(key).agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in columns])
    counts = per_key.agg(F.count("*").alias("total_keys"), *[F.count_if(F.col(c)).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nonnull_keys")) for c in columns])
    return counts.select("total_keys", F.inline(cells)).select(
        "column_name", "nonnull_keys", "total_keys",
        ratio(F.col("nonnull_keys"), F.col("total_keys")).alias("nonnull_fraction"),
    )


def comparator(left: DataFrame, right: DataFrame, key: str, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Agreement of computed columns with published ones, one row per pair.

    ``pairs`` maps a label to SQL texts over the joined row.
    """
    joined = left.join(right, key)
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("comparison"), F.expr(a).cast("double").alias("a"), F.expr(b).cast("double").alias("b"))
            for n, (a, b) in pairs.items()
        ]
    )
    rows = joined.select(F.inline(cells)).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    rows = rows.withColumn("gap", F.abs(F.col("a") - F.col("b")))  # a row per map unit and pair, kept while it is read again
    counts = rows.groupBy("comparison").agg(
        F.count("*").alias("n"), F.corr("a", "b").alias("correlation"),
        F.avg((F.col("a") == F.col("b")).cast("double")).alias("equal_share"),
    )
    gaps = exact_percentiles(rows, "comparison", "gap", {"median_gap": 0.5, "p95_gap": 0.95})
    return counts.join(gaps, "comparison").select(
        "comparison", "n", "correlation", "median_gap", "p95_gap", "equal_share"
    )


BUCKETS = 4096


def exact_percentiles(rows: DataFrame, group: str, value: str, wanted: dict[str, float]) -> DataFrame:
    """Interpolated percentiles per group, exact at every size and for every distribution.

    Selection by histogram: each rank wanted has a bracket of values that holds it,
    at first from the smallest to the largest.  A round counts the values of all
    brackets in equal steps, in one pass, and narrows each bracket to the least and
    largest value of the step that holds the rank.  The two ends always fall into
    different steps, so brackets shrink until both ends are one value, which is the
    rank's.  Tasks and driver hold ``BUCKETS`` counts a bracket, whatever the number
    of rows.  ``group`` names one of a few labels; missing values and NaN don't count.
    """
    spark = rows.sparkSession
    v = F.col(value).cast("double")
    kept = rows.select(F.col(group).alias("g"), v.alias("v")).where(v.isNotNull() & ~F.isnan(v)).persist()
    ends = {r["g"]: r for r in kept.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    ranks = {(g, n, side): (int(p * (r["n"] - 1)) + side) if side == 0 or p * (r["n"] - 1) % 1 else int(p * (r["n"] - 1))
             for g, r in ends.items() for n, p in wanted.items() for side in (0, 1)}
    # (group, rank) to (lo, hi, values below lo)
    brackets = {(g, k): (ends[g]["lo"], ends[g]["hi"], 0) for (g, _, _), k in ranks.items()}
    while open_ones := [(g, k, lo, hi, below) for (g, k), (lo, hi, below) in brackets.items() if lo < hi]:
        found = spark.createDataFrame(open_ones, f"g {rows.schema[group].dataType.simpleString()}, k bigint, lo double, hi double, below bigint")
        inside = kept.join(F.broadcast(found), "g").where("v between lo and hi")  # a bracket a rank of a label
        step = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * BUCKETS), F.lit(BUCKETS - 1))
        bucket = F.when(F.col("v") == F.col("hi"), BUCKETS - 1).when(F.col("v") == F.col("lo"), 0).otherwise(step)
        counts = inside.groupBy("g", "k", "below", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("n").over(Window.partitionBy("g", "k").orderBy("bucket"))
        holding = counts.withColumn("upto", F.col("below") + upto).where("upto > k and upto - n <= k")
        for r in holding.collect():
            brackets[r["g"], r["k"]] = (r["lo"], r["hi"], r["upto"] - r["n"])
    kept.unpersist()
    out = []
    for g, r in ends.items():
        row = [g]
        for name, p in wanted.items():
            low, high = (brackets[g, ranks[g, name, side]][0] for side in (0, 1))
            part = p * (r["n"] - 1) % 1
            row.append(low if low == high or not part else low + part * (high - low))
        out.append(tuple(row))
    kind = rows.schema[group].dataType.simpleString()
    return spark.createDataFrame(out, f"{group} {kind}, " + ", ".join(f"{n} double" for n in wanted))
