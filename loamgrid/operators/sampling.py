"""Samples that depend on the seed and the data, never on how the work is split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.pixels import mapped, tile_summary, with_tiles


def draw(seed: int, *columns: str) -> Column:
    """A reproducible draw per row from its own identity."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))


def pixel_sample(pixels: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` mapped cells.  Each task keeps its own best ``n``; nothing is sorted whole."""
    order = draw(seed, "region", "row_no", "col_no")
    return mapped(pixels).withColumn("draw", order).orderBy("draw", "region", "row_no", "col_no").limit(n)


def tile_sample(pixels: DataFrame, k: int, seed: int, size: int) -> DataFrame:
    """All mapped cells of ``k`` tiles drawn from the tiles that have any."""
    tiles = tile_summary(pixels, size).select("region", "tile_y", "tile_x")
    order = draw(seed, "region", "tile_y", "tile_x")
    chosen = tiles.withColumn("draw", order).orderBy("draw", "region", "tile_y", "tile_x").limit(k)
    return with_tiles(mapped(pixels), size).join(F.broadcast(chosen.drop("draw")), ["region", "tile_y", "tile_x"], "left_semi")
