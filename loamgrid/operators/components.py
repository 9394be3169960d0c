"""Component filters and the choice of the dominant component."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import default_text

# Product name of each terrain column.
TERRAIN = {"slope": "slope_r", "slope_length": "slopelenusle_r", "elevation": "elev_r", "aspect": "aspectrep"}

MISCELLANEOUS = "Miscellaneous area"


def positive_percent() -> Column:
    """Null-safe test for a usable weight."""
    return F.coalesce(F.col("comppct_r") > 0, F.lit(False))


def weights(components: DataFrame) -> DataFrame:
    """Components that may carry weight."""
    return components.select("mukey", "cokey", "comppct_r").where(positive_percent())


def is_major() -> Column:
    return default_text("majcompflag") == "Yes"


def is_earthy_major() -> Column:
    """Major components of a kind that can support plants."""
    earthy = F.coalesce(F.col("compkind") != MISCELLANEOUS, F.lit(False))
    return is_major() & earthy & positive_percent()


def earthy_major(components: DataFrame) -> DataFrame:
    return components.where(is_earthy_major())


def rank_of_component() -> Column:
    """Smallest first: major before minor, larger percent, then key as text."""
    return F.struct(
        (~is_major()).alias("minor"), (-F.col("comppct_r")).alias("negative_percent"), F.col("cokey").alias("cokey")
    )


def pick_dominant(*columns: str) -> Column:
    """Aggregate: the named columns of the dominant component of a group."""
    picked = F.struct(*columns)
    return F.min_by(F.when(F.col("comppct_r").isNotNull(), picked),
                    F.when(F.col("comppct_r").isNotNull(), rank_of_component()))


def dominant_component(components: DataFrame, *extra: str) -> DataFrame:
    """One component per map unit, with any further columns of that same row.

    ``min_by`` combines partially on the map side, so a map unit with very many
    components is reduced before it is shuffled and never sorted in one task.
    """
    columns = ("cokey", "comppct_r", "majcompflag", *extra)
    return (
        components.where(F.col("comppct_r").isNotNull()).groupBy("mukey")
        .agg(pick_dominant(*columns).alias("d")).select("mukey", "d.*")
    )


def terrain(components: DataFrame) -> DataFrame:
    """Terrain values of the dominant component, never averaged."""
    chosen = dominant_component(components, *TERRAIN.values())
    return chosen.select("mukey", *[F.col(c).alias(name) for name, c in TERRAIN.items()])


def terrain_audit(components: DataFrame) -> DataFrame:
    """Which component was chosen for each map unit."""
    return dominant_component(components).select(
        "mukey", F.col("cokey").alias("selected_cokey"), F.col("comppct_r").alias("selected_comppct_r"),
        F.col("majcompflag").alias("selected_majcompflag"),
    )


def component_percent_sum(components: DataFrame) -> DataFrame:
    """Percent over all listed components; deliberately not limited to 100."""
    return (
        components.where(F.col("comppct_r").isNotNull()).groupBy("mukey").agg(F.sum("comppct_r").alias("musumcpct"))
    )
