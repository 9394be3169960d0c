"""The pixel table: one row per mapped cell, background left out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model.regions import REGIONS, Region, region_frame

BACKGROUND = 0
TILE = 4096
CELL = ("region", "row_no", "col_no")


def mapped(pixels: DataFrame) -> DataFrame:
    return pixels.where(F.col("mukey") != BACKGROUND)


def read_pixels(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    """Mapped cells, restricted to one region's partitions when asked."""
    df = mapped(spark.read.parquet(path))
    return df if region is None else df.where(F.col("region") == region)


def with_tiles(pixels: DataFrame, size: int = TILE) -> DataFrame:
    """Aligned square tiles.  Each cell falls in exactly one of them."""
    return pixels.withColumn("tile_y", F.floor(F.col("row_no") / size).cast("int")).withColumn(
        "tile_x", F.floor(F.col("col_no") / size).cast("int")
    )


def tile_grid(spark: SparkSession, regions: tuple[Region, ...] = REGIONS, size: int = TILE) -> DataFrame:
    """Every tile of every grid with its half-open cell range; edge tiles are clipped."""
    grid = region_frame(spark, regions)
    down = F.sequence(F.lit(0), ((F.col("height") - 1) / size).cast("int"))
    across = F.sequence(F.lit(0), ((F.col("width") - 1) / size).cast("int"))
    return (
        grid.withColumn("tile_y", F.explode(down)).withColumn("tile_x", F.explode(across))
        .select(
            "region", "tile_y", "tile_x",
            (F.col("tile_y") * size).alias("row_from"),
            F.least((F.col("tile_y") + 1) * size, F.col("height")).alias("row_to"),
            (F.col("tile_x") * size).alias("col_from"),
            F.least((F.col("tile_x") + 1) * size, F.col("width")).alias("col_to"),
        )
    )


def tile_summary(pixels: DataFrame, size: int = TILE) -> DataFrame:
    """Mapped cells and their extent per tile; tiles without any do not appear."""
    return with_tiles(mapped(pixels), size).groupBy("region", "tile_y", "tile_x").agg(
        F.count("*").alias("mapped_pixels"),
        F.min("row_no").alias("min_row"), F.max("row_no").alias("max_row"),
        F.min("col_no").alias("min_col"), F.max("col_no").alias("max_col"),
    )


@dataclass(frozen=True)
class PixelTable:
    """Tiled cells with what is known of them: pixels per (region, key) and mapped cells per tile."""

    cells: DataFrame
    keys: DataFrame
    tiles: DataFrame


def _keys(cells: DataFrame) -> DataFrame:
    return cells.groupBy("region", "mukey").agg(F.count("*").alias("pixels"))


def _tiles(cells: DataFrame) -> DataFrame:
    return cells.groupBy("region", "tile_y", "tile_x").agg(F.count("*").alias("mapped_pixels"))


def describe(pixels: DataFrame) -> PixelTable:
    """A tiled pixel table whose counts are not stored; each is a pass over it when asked for."""
    cells = mapped(pixels)
    return PixelTable(cells, _keys(cells), _tiles(cells))


def write_pixels(pixels: DataFrame, path: str, size: int = TILE) -> PixelTable:
    """Store mapped cells by region and tile, and beside them their keys and tiles.

    A tile holds at most ``size * size`` cells, so no task or file outgrows it.
    What later steps ask about the pixels is answered by the two small tables:
    which tiles there are, which keys, and which of them are hot.
    """
    (
        with_tiles(mapped(pixels), size).repartition("region", "tile_y", "tile_x")
        .sortWithinPartitions("region", "tile_y", "tile_x", "row_no", "col_no")
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy("region", "tile_y", "tile_x").parquet(path)
    )
    stored = pixels.sparkSession.read.parquet(path)
    _keys(stored).sortWithinPartitions("region", "mukey").write.mode("overwrite").parquet(f"{path}_keys")
    _tiles(stored).write.mode("overwrite").parquet(f"{path}_tiles")
    return open_pixels(pixels.sparkSession, path)


def open_pixels(spark: SparkSession, path: str) -> PixelTable:
    """What ``write_pixels`` stored; opening it starts no job but the reading of footers."""
    return PixelTable(*[spark.read.parquet(p) for p in (path, f"{path}_keys", f"{path}_tiles")])


def in_box(row_from: int, row_to: int, col_from: int, col_to: int) -> Column:
    """Half-open box of cells."""
    return (
        (F.col("row_no") >= row_from) & (F.col("row_no") < row_to)
        & (F.col("col_no") >= col_from) & (F.col("col_no") < col_to)
    )


def window(
    pixels: DataFrame, region: str, row_from: int, row_to: int, col_from: int, col_to: int, *, size: int = TILE,
) -> DataFrame:
    """Cells of a box.  On a tiled table the tile bounds prune partitions first."""
    out = pixels.where((F.col("region") == region) & in_box(row_from, row_to, col_from, col_to))
    if "tile_y" in pixels.columns:
        out = out.where(
            F.col("tile_y").between(row_from // size, (row_to - 1) // size)
            & F.col("tile_x").between(col_from // size, (col_to - 1) // size)
        )
    return out


def grid_conformance(first: DataFrame, second: DataFrame, regions: DataFrame) -> DataFrame:
    """Do two cell tables of each region cover the same cells inside the declared grid?"""

    def extent(df: DataFrame, prefix: str) -> DataFrame:
        return df.groupBy("region").agg(
            F.min("row_no").alias(f"{prefix}_min_row"), F.max("row_no").alias(f"{prefix}_max_row"),
            F.min("col_no").alias(f"{prefix}_min_col"), F.max("col_no").alias(f"{prefix}_max_col"),
            F.count("*").alias(f"{prefix}_pixels"),
        )

    both = regions.select("region", "width", "height").join(extent(first, "a"), "region", "left").join(
        extent(second, "b"), "region", "left"
    )
    present = F.col("a_pixels").isNotNull() & F.col("b_pixels").isNotNull()
    inside = (
        (F.least("a_min_row", "b_min_row", "a_min_col", "b_min_col") >= 0)
        & (F.greatest("a_max_row", "b_max_row") < F.col("height"))
        & (F.greatest("a_max_col", "b_max_col") < F.col("width"))
    )
    alike = (
        (F.col("a_min_row") == F.col("b_min_row")) & (F.col("a_max_row") == F.col("b_max_row"))
        & (F.col("a_min_col") == F.col("b_min_col")) & (F.col("a_max_col") == F.col("b_max_col"))
    )
    return both.select(
        "region",
        F.coalesce(F.col("a_pixels"), F.lit(0)).alias("first_pixels"),
        F.coalesce(F.col("b_pixels"), F.lit(0)).alias("second_pixels"),
        F.coalesce(inside, F.lit(False)).alias("inside_grid"),
        F.coalesce(alike, F.lit(False)).alias("same_extent"),
        (present & F.coalesce(inside & alike, F.lit(False))).alias("passed"),
    )
