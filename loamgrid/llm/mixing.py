"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis-Spirakis).

Every document gets an exponential key scaled by its quality weight; within its
source, documents are taken in key order until the word budget is spent.  A
budget beyond the source takes whole epochs first and a fraction by keys.

Nothing is sorted whole: keys fall into a fixed number of ranges per source, the
ranges are prefix-summed, and only the one range per source in which the budget
ends is ranked row by row.

Defined cases: null or empty text has size 0 and is taken freely at no words; a
null source is a source, ordered last; a null id is hashed as the empty text;
repeated rows are rows of their own, with ties by id and by text; an empty table
gives an empty result; further columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store

WORDS = r"[^\x20\x09-\x0D]+"


def quality(text: str, size: str) -> str:
    """SQL text of a quality weight in (0, 1]: how near the mean word length is to ordinary prose."""
    return f"1.0D / (1.0D + abs(ln((length({text}) + 1.0D) / ({size} + 1.0D) / 6.5D)))"


def targets(sizes: DataFrame, share: float, weights: Sequence[float], cap: float) -> DataFrame:
    """Budget per source by weight, none above ``cap`` times its size, the excess reshared.

    Closed form: in order of size over weight the sources at their cap are a
    prefix.  One row per source, so the windows see as many rows as sources.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("level", F.col("source").asc_nulls_last())
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("weight", cycle[((F.row_number().over(by_name) - 1) % len(weights)).cast("int")])
        .withColumn("limit", F.col("source_size") * F.lit(float(cap)))
        .withColumn("level", F.col("limit") / F.col("weight"))
        .withColumn("pool", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("even", (F.col("pool") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    )
    # the first source that isn't at its cap fixes the level of all after it
    ranked = ranked.withColumn("flat", F.when(F.col("level") >= F.col("even"), F.col("even")))
    first = ranked.withColumn("flat", F.first("flat", ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, 0)))
    return first.select("source", "source_size", F.coalesce(F.col("flat") * F.col("weight"), F.col("limit")).alias("target"))


def mix(
    docs: DataFrame, *, share: float = 1.5, weights: Sequence[float] = (3, 1, 2), cap: float = 2.0, ranges: int = 1024,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, quality, key; one row per row of ``docs``."""
    sized = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).select(
        "doc_id", "source", "size", F.expr(quality("text", "size")).alias("quality"), F.md5("text").alias("tie"),
        F.expr("(cast(conv(substr(md5(coalesce(cast(doc_id as string), '')), 1, 13), 16, 10) as double) + 0.5D)"
               " / 4503599627370496.0D").alias("u"),
    ).select(
        "doc_id", "source", "size", "quality", "tie", (-F.log("u") / F.col("quality")).alias("key"),
    )
    sized = store(sized.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * (ranges - 1)).cast("int")))
    plan = store(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, weights, cap))
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(0).cast("long"))
    plan = plan.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    parts = sized.groupBy("source", "range").agg(F.sum("size").alias("words"))
    parts = parts.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    parts = parts.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    parts = store(parts.withColumn(
        "whole", F.when(F.col("before") + F.col("words") <= F.col("budget"), True).when(F.col("before") < F.col("budget"), None)
        .otherwise(False),
    ).withColumnsRenamed({"source": "s", "range": "r"}))
    rows = sized.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.where("whole is null").withColumn(
        "whole", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("size") / 2 <= F.col("budget"),
    )
    out = rows.where("whole is not null").unionByName(cut)
    copies = F.col("epochs") + F.col("whole").cast("long")
    return out.select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "quality", "key",
    )
