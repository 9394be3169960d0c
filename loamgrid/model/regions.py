"""The region dimension: native grids, north-up square cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Region:
    name: str
    token: str  # spelling used in source file names
    epsg: int
    pixel_size: float
    width: int
    height: int
    x_min: float  # outer edge of the first column
    y_max: float  # outer edge of the first row

    @property
    def units(self) -> str:
        return "degree" if self.epsg == 4326 else "m"

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        """(west, south, east, north) of the outer edges."""
        return (
            self.x_min,
            self.y_max - self.height * self.pixel_size,
            self.x_min + self.width * self.pixel_size,
            self.y_max,
        )


# The twelve source grids of the 2026-02-13 release.
REGIONS: tuple[Region, ...] = (
    Region("alaska", "Alaska", 3338, 30.0, 122_295, 65_835, -2_175_735.0, 2_383_905.0),
    Region("american_samoa", "American_Samoa", 4326, 0.00027131, 5_264, 805, -170.846755755, -14.155463595),
    Region("conus", "CONUS", 5070, 30.0, 153_996, 97_053, -2_356_125.0, 3_172_575.0),
    Region("fed_states_micronesia", "Fed_States_Micronesia", 4326, 0.00027131, 92_073, 17_599, 138.054872605, 10.033722075),
    Region("guam", "Guam", 4326, 0.00027131, 1_249, 1_549, 144.618132815, 13.654354025),
    Region("hawaii", "Hawaii", 4326, 0.00027131, 18_360, 12_252, -159.788160155, 22.235075395),
    Region("marshall_is", "Marshall_Is", 4326, 0.00027131, 2_715, 9_728, 171.027176905, 8.712442375),
    Region("mexico", "Mexico", 5070, 30.0, 370, 451, -486_045.0, 471_885.0),
    Region("northern_mariana_is", "Northern_Mariana_Is", 4326, 0.00027131, 2_694, 17_333, 145.121412865, 18.813313675),
    Region("palau", "Palau", 4326, 0.00027131, 13_272, 18_879, 131.120189005, 8.094126885),
    Region("puerto_rico", "Puerto_Rico", 32161, 30.0, 9_978, 2_721, 34_335.0, 281_445.0),
    Region("virgin_is", "Virgin_Is", 32161, 30.0, 2_280, 3_104, 335_265.0, 270_585.0),
)

REGION_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType(), False),
        T.StructField("epsg", T.IntegerType(), False),
        T.StructField("pixel_size", T.DoubleType(), False),
        T.StructField("width", T.IntegerType(), False),
        T.StructField("height", T.IntegerType(), False),
        T.StructField("x_min", T.DoubleType(), False),
        T.StructField("y_max", T.DoubleType(), False),
    ]
)


def region_frame(spark: SparkSession, regions: tuple[Region, ...] = REGIONS) -> DataFrame:
    """The dimension as a DataFrame: one row per grid."""
    rows = [(r.name, r.epsg, r.pixel_size, r.width, r.height, r.x_min, r.y_max) for r in regions]
    return spark.createDataFrame(rows, REGION_SCHEMA)
