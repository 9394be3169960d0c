"""Two-level weighted aggregation: horizons to components, components to map units.

A *measure* says which horizons count, what each contributes and whether the
component value is a mean over thickness or a total.  Any number of measures
share one pass: each adds a few sums to the same two aggregates, instead of a
pass and an outer join of its own.

How the work is laid out
------------------------
Horizons meet their component before they are expanded over the intervals.  The
join's shuffle on the component key moves each narrow horizon row once; the
expansion, the component aggregate and the partial map-unit aggregate then run
in the same stage on the same partitioning.  Aggregating first would shuffle one
wide row of sums per (component, interval), which is several times the data.

A component that holds a large share of all horizons would make one task of that
stage long.  Two things prevent it: adaptive execution splits such a partition
at run time (``session.tune``), and ``hot`` names components known to be large,
whose rows stay where they are and are aggregated before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model.intervals import DEPTH, INTERVALS, WHOLE_PROFILE
from .components import dominant_component, weights
from .overlap import NUMBER, OVERLAP, interval_overlaps, valid_horizons, with_label

MAP_UNIT_KEY = ("mukey", DEPTH)
COMPONENT = ("cokey", "mukey", "comppct_r", "dominant")
HELD = "held"
WHOLE_NUMBER = next(n for n, i in enumerate(INTERVALS) if i.label == WHOLE_PROFILE)


@dataclass(frozen=True)
class Measure:
    """``outputs`` maps a result column to the SQL text of its horizon value."""

    name: str
    outputs: tuple[tuple[str, str], ...]
    needs: tuple[str, ...]  # columns that must all be present
    also: tuple[str, ...] = ()  # columns read but not required
    per_thickness: bool = True  # mean over thickness; otherwise a plain total

    @property
    def mask(self) -> str:
        return " and ".join(f"{c} is not null" for c in self.needs)

    @property
    def thickness(self) -> str:
        return f"{self.name}__thickness"

    @property
    def percent(self) -> str:
        return f"{self.name}__percent"

    def component_sums(self) -> list[str]:
        sums = [f"sum(case when {self.mask} then {OVERLAP} end) as {self.name}__cm"]
        for out, text in self.outputs:
            value = f"({text}) * {OVERLAP}"
            # a single needed column makes its own product null; no test required
            counted = value if self.needs == (text,) else f"case when {self.mask} then {value} end"
            sums.append(f"sum({counted}) as {out}__sum")
        return sums

    def map_unit_sums(self, weight: str) -> list[str]:
        cm = f"{self.name}__cm"
        sums = [
            f"sum(case when {cm} is not null then {weight} end) as {self.percent}",
            f"sum({cm} * {weight}) as {self.thickness}",
        ]
        for out, _ in self.outputs:
            value = f"{out}__sum / {cm}" if self.per_thickness else f"{out}__sum"
            sums.append(f"sum({value} * {weight}) as {out}")
        return sums

    def finished(self) -> list[str]:
        """Renormalise over the percent that contributed; absent stays null."""
        values = [f"{out} / {self.percent} as {out}" for out, _ in self.outputs]
        return [*values, f"{self.thickness} / {self.percent} as {self.thickness}", self.percent]


def linear(name: str, column: str) -> Measure:
    """Thickness-weighted mean of one column."""
    return Measure(name, ((name, column),), (column,))


def composition(name: str, parts: dict[str, str]) -> Measure:
    """Several parts under one mask, so that they keep adding up to the whole."""
    return Measure(name, tuple(parts.items()), tuple(parts.values()))


def stock(name: str, per_cm: str, needs: Sequence[str], also: Sequence[str] = ()) -> Measure:
    """Total of ``per_cm`` times overlap over the horizons that have the inputs."""
    return Measure(name, ((name, per_cm),), tuple(needs), tuple(also), per_thickness=False)


def with_held(horizons: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """Marks the horizons that any measure counts.

    Sums then know by one column which rows to keep, and a caller that reads few
    of them moves no column of the others.  To be set before any join.
    """
    return horizons.withColumn(HELD, F.expr(" or ".join(f"({m.mask})" for m in measures)))


def component_measures(
    overlaps: DataFrame, measures: Sequence[Measure], extra: Sequence[str] = (), keys: Sequence[str] = ("cokey",),
) -> DataFrame:
    """First level: one row per (component, interval)."""
    sums = [s for m in measures for s in m.component_sums()]
    return overlaps.groupBy(*keys, NUMBER).agg(*[F.expr(s) for s in (*sums, *extra)])


def weighed_components(components: DataFrame, *, mark_dominant: bool) -> DataFrame:
    """One narrow row per component that may contribute."""
    narrow = components.select("mukey", "cokey", "comppct_r").where(F.col("comppct_r").isNotNull())
    if not mark_dominant:
        return narrow.withColumn("dominant", F.lit(False))
    chosen = dominant_component(components).select("cokey", F.lit(True).alias("chosen"))
    return narrow.join(chosen, "cokey", "left").select(
        "mukey", "cokey", "comppct_r", F.col("chosen").isNotNull().alias("dominant")
    )


def component_level(
    horizons: DataFrame, weighed: DataFrame, measures: Sequence[Measure], extra: Sequence[str], columns: Sequence[str],
    hot: Sequence[str] = (),
) -> DataFrame:
    """Component sums with the component's map unit and weight.

    The build side has one short row per component, a small fraction of the
    horizons that probe it, so hashing it costs no sort of the wide side.
    """
    narrow = valid_horizons(horizons).select("cokey", "hzdept_r", "hzdepb_r", *columns)
    keep = [*COMPONENT, *columns]

    def aggregate(rows: DataFrame) -> DataFrame:
        return component_measures(interval_overlaps(rows, keep), measures, extra, COMPONENT)

    if not hot:
        return aggregate(narrow.join(weighed.hint("shuffle_hash"), "cokey"))
    is_hot = F.coalesce(F.col("cokey").isin(list(hot)), F.lit(False))
    # few keys by definition, so their component rows are few as well
    near = aggregate(narrow.where(is_hot).join(F.broadcast(weighed.where(is_hot)), "cokey"))
    far = aggregate(narrow.where(~is_hot).join(weighed.where(~is_hot).hint("shuffle_hash"), "cokey"))
    return near.unionByName(far)


def map_unit_level(
    by_component: DataFrame, measures: Sequence[Measure], extra_sums: Sequence[str] = (),
    extra_finished: Sequence[str] = (), present: Sequence[str] = (), labelled: bool = True, marked: bool = False,
) -> DataFrame:
    """Second level: one row per (map unit, interval) that any measure could fill.

    With ``marked`` the component sums say so in the column of ``with_held``.

    Unlabelled rows keep the interval number they are partitioned by, for a join
    on the same key.
    """
    weight = "case when comppct_r > 0 then comppct_r end"
    sums = [s for m in measures for s in m.map_unit_sums(weight)]
    filled = [f"{c} is not null" for c in present]
    if marked:
        sums.append(f"max(case when comppct_r > 0 then {HELD} end) as {HELD}")
        filled.append(f"coalesce({HELD}, false)")
    else:
        filled += [f"{m.percent} is not null" for m in measures]
    rows = by_component.groupBy("mukey", NUMBER).agg(*[F.expr(s) for s in (*sums, *extra_sums)]).where(" or ".join(filled))
    out = rows.selectExpr("mukey", NUMBER, *[c for m in measures for c in m.finished()], *extra_finished)
    return with_label(out, "mukey") if labelled else out


def measure_columns(measures: Sequence[Measure]) -> list[str]:
    return list(dict.fromkeys(c for m in measures for c in (*m.needs, *m.also)))


def map_unit_measures(
    horizons: DataFrame, components: DataFrame, measures: Sequence[Measure], *, hot: Sequence[str] = (),
    labelled: bool = True,
) -> DataFrame:
    """Any measures per (map unit, interval), each with its thickness and percent."""
    weighed = weighed_components(components, mark_dominant=False)
    return map_unit_level(
        component_level(horizons, weighed, measures, [], measure_columns(measures), hot), measures, labelled=labelled
    )


def measure_map_units(horizons: DataFrame, components: DataFrame, measure: Measure) -> DataFrame:
    """One measure on its own, under the plain diagnostic names."""
    return map_unit_measures(horizons, components, [measure]).select(
        *MAP_UNIT_KEY, *[o for o, _ in measure.outputs],
        F.col(measure.thickness).alias("contributing_thickness"),
        F.col(measure.percent).alias("contributing_component_percent"),
    )


def least_transmissive(horizons: DataFrame, components: DataFrame, column: str = "ksat_r") -> DataFrame:
    """Smallest value the dominant component meets in each interval.

    Only dominant components survive the join, and each is its map unit's only
    one, so a single aggregate remains.
    """
    chosen = dominant_component(components).select("mukey", "cokey", "comppct_r")
    rows = valid_horizons(horizons).where(F.col(column).isNotNull()).select("cokey", "hzdept_r", "hzdepb_r", column)
    met = interval_overlaps(rows.join(chosen, "cokey"), ["mukey", "comppct_r", column])
    return with_label(
        met.groupBy("mukey", NUMBER).agg(
            F.min(column).alias("value"), F.sum(OVERLAP).alias("contributing_thickness"),
            F.max("comppct_r").alias("contributing_component_percent"),
        ),
        "mukey",
    )


def admitted_percent(horizons: DataFrame, components: DataFrame, measure: Measure, name: str) -> DataFrame:
    """Percent of components with at least one counting horizon anywhere.

    Every interval lies inside the whole profile, so a component that counts
    anywhere has a counting horizon that reaches below the surface.
    """
    found = (
        valid_horizons(horizons).where("hzdepb_r > 0").where(measure.mask).select("cokey").distinct()
    )
    return weights(components).join(found, "cokey", "left_semi").groupBy("mukey").agg(F.sum("comppct_r").alias(name))
