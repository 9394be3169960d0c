"""Horizons laid over the depth intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model.intervals import DEPTH, INTERVALS, Interval

OVERLAP = "overlap_cm"
NUMBER = "interval_no"


def valid_horizons(horizons: DataFrame) -> DataFrame:
    """Horizons with both depths and a positive thickness."""
    return horizons.where(
        F.col("hzdept_r").isNotNull() & F.col("hzdepb_r").isNotNull() & (F.col("hzdepb_r") > F.col("hzdept_r"))
    )


def profile_bottom(horizons: DataFrame) -> DataFrame:
    """Depth to which each component is described."""
    return valid_horizons(horizons).groupBy("cokey").agg(F.max("hzdepb_r").alias("profile_bottom"))


def overlap_with(interval: Interval) -> str:
    """Centimetres of the horizon inside one interval; zero or less means none.

    An open interval ends at the component's profile bottom.  No horizon reaches
    below its own component's profile bottom, so ``least(bottom, profile bottom)``
    is the horizon's bottom itself and the profile bottom need not be known.
    """
    bottom = "hzdepb_r" if interval.open_ended else f"least(hzdepb_r, {interval.bottom_cm}D)"
    return f"{bottom} - greatest(hzdept_r, {interval.top_cm}D)"


def with_label(df: DataFrame, *first: str) -> DataFrame:
    """Replace the interval number by its label, after the given columns."""
    labels = ", ".join(f"'{i.label}'" for i in INTERVALS)
    rest = [c for c in df.columns if c not in (*first, NUMBER)]
    return df.selectExpr(*first, f"element_at(array({labels}), {NUMBER} + 1) as {DEPTH}", *rest)


def interval_overlaps(
    horizons: DataFrame, columns: Sequence[str] | None = None, intervals: Sequence[Interval] = INTERVALS,
) -> DataFrame:
    """One row per (horizon, interval) that meet: a range join without a join.

    The dimension is fixed and small, so each horizon row generates its own
    matches: one scan, no shuffle, no nested loop.  Name the ``columns`` to keep;
    everything else is pruned before the rows multiply.  Rows carry the number
    of the interval, a short fixed-width grouping key; ``with_label`` names it.
    """
    keep = list(columns) if columns is not None else horizons.columns
    cells = ", ".join(
        f"struct({INTERVALS.index(i)} as {NUMBER}, {overlap_with(i)} as {OVERLAP})" for i in intervals
    )
    return valid_horizons(horizons).selectExpr(*keep, f"inline(array({cells}))").where(F.col(OVERLAP) > 0)
