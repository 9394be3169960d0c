"""Horizon properties per map unit and interval, all in a single pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .measures import (
    HELD, MAP_UNIT_KEY, Measure, component_level, composition, linear, map_unit_level, map_unit_measures, measure_columns,
    stock, weighed_components,
)
from .overlap import OVERLAP

# Product name of each horizon column under the linear mean.
LINEAR: dict[str, str] = {
    "organic_matter": "om_r",
    "bulk_density_tenth_bar": "dbtenthbar_r",
    "bulk_density_one_third_bar": "dbthirdbar_r",
    "bulk_density_fifteen_bar": "dbfifteenbar_r",
    "bulk_density_oven_dry": "dbovendry_r",
    "awc": "awc_r",
    "water_content_tenth_bar": "wtenthbar_r",
    "water_content_one_third_bar": "wthirdbar_r",
    "water_content_fifteen_bar": "wfifteenbar_r",
    "satiated_water_content": "wsatiated_r",
    "cec_7": "cec7_r",
    "effective_cec": "ecec_r",
    "sum_of_bases": "sumbases_r",
    "ph": "ph1to1h2o_r",
}
PARTS = {"sand": "sandtotal_r", "silt": "silttotal_r", "clay": "claytotal_r"}
PROPERTIES = [*PARTS, "ksat", *LINEAR]

PARTICLE_SIZE = composition("particle_size_shared_mask", PARTS)
LINEAR_MEASURES: tuple[Measure, ...] = tuple(linear(n, c) for n, c in LINEAR.items())

# Organic matter per unit of organic carbon; unit conversions.
OM_PER_OC = 1.724
AWS = stock("aws", "awc_r * 10D", ("awc_r",))
SOC = stock(
    "soc",
    f"dbthirdbar_r * (om_r / {OM_PER_OC}D / 100D) * (1D - coalesce(fragvol, 0D) / 100D) * 10000D",
    ("om_r", "dbthirdbar_r"), ("fragvol",),
)

_KSAT = "ksat"


def fragment_volume(chfrags: DataFrame) -> DataFrame:
    """Percent of rock fragments per horizon, limited to 0..100.

    Rows are dealt out before they are added: a horizon has few of them, so that
    combining within a scan task hardly saves a row, but would hold every key of it.
    """
    total = F.sum("fragvol_r")
    return (
        chfrags.where(F.col("fragvol_r").isNotNull()).select("chkey", "fragvol_r").repartition("chkey").groupBy("chkey")
        .agg(F.greatest(F.lit(0.0), F.least(F.lit(100.0), total)).alias("fragvol"))
    )


def with_fragments(horizons: DataFrame, chfrags: DataFrame) -> DataFrame:
    """Horizons with their fragment volume; none recorded means none.

    Joined before the intervals multiply the rows; one row per key on each side.
    """
    return horizons.join(fragment_volume(chfrags), "chkey", "left").withColumn(
        "fragvol", F.coalesce("fragvol", F.lit(0.0))
    )


def property_sums(
    components: DataFrame, horizons: DataFrame, measures: Sequence[Measure], *, ksat: bool = True, hot: Sequence[str] = (),
    labelled: bool = True, marked: bool = False,
) -> DataFrame:
    """Every measure and the conductivity minimum per (map unit, interval).

    One scan of the horizons, one join, one aggregate per component and one per
    map unit serve all properties.  A property that no component could supply is
    null in its own columns only.  ``marked`` horizons come from ``with_held``
    with the same measures.
    """
    if not ksat:
        return map_unit_measures(horizons, components, measures, hot=hot, labelled=labelled)
    extra = [
        "min(ksat_r) as ksat__least",
        f"sum(case when ksat_r is not null then {OVERLAP} end) as ksat__cm",
    ]
    columns = list(dict.fromkeys([*measure_columns(measures), "ksat_r"]))
    if marked:
        extra.append(f"max({HELD}) as {HELD}")
        columns.append(HELD)
    weighed = weighed_components(components, mark_dominant=True)
    by_component = component_level(horizons, weighed, measures, extra, columns, hot)
    here = "case when dominant and ksat__cm is not null then"
    return map_unit_level(
        by_component, measures,
        extra_sums=[
            f"max({here} ksat__least end) as {_KSAT}", f"max({here} ksat__cm end) as ksat__thickness",
            f"max({here} comppct_r end) as ksat__percent",
        ],
        extra_finished=[_KSAT, "ksat__thickness", "ksat__percent"], present=["ksat__thickness"],
        labelled=labelled, marked=marked,
    )


def wide_properties(sums: DataFrame) -> DataFrame:
    """The eighteen properties and the shared particle-size coverage pair."""
    return sums.selectExpr(
        *MAP_UNIT_KEY, *PROPERTIES,
        f"{PARTICLE_SIZE.thickness} as particle_size_contributing_thickness",
        f"{PARTICLE_SIZE.percent} as particle_size_contributing_component_percent",
    )


def _diagnosed() -> list[str]:
    return [PARTICLE_SIZE.name, _KSAT, *LINEAR]


def long_diagnostics(sums: DataFrame) -> DataFrame:
    """Coverage behind every property as rows, generated from the same wide row."""
    cells = ", ".join(
        f"struct('{n}' as property, {n}__thickness as contributing_thickness, {n}__percent as contributing_component_percent)"
        for n in _diagnosed()
    )
    return sums.selectExpr(*MAP_UNIT_KEY, f"inline(array({cells}))").where("contributing_thickness is not null")


def horizon_properties(components: DataFrame, horizons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(wide properties, long diagnostics) from one shared single-pass plan."""
    sums = property_sums(components, horizons, [PARTICLE_SIZE, *LINEAR_MEASURES])
    return wide_properties(sums), long_diagnostics(sums)
