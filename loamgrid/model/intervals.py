"""The depth-interval dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Interval:
    label: str
    top_cm: int
    bottom_cm: int | None  # None: down to the bottom of the described profile
    kind: str
    suffix: str  # spelling used by the wide summary columns

    @property
    def open_ended(self) -> bool:
        return self.bottom_cm is None


# The eleven published intervals, in their published order.
INTERVALS: tuple[Interval, ...] = (
    Interval("0_5", 0, 5, "layer_and_zone", "0_5"),
    Interval("5_20", 5, 20, "layer", "5_20"),
    Interval("20_50", 20, 50, "layer", "20_50"),
    Interval("50_100", 50, 100, "layer", "50_100"),
    Interval("100_150", 100, 150, "layer", "100_150"),
    Interval("150_profile", 150, None, "layer", "150_999"),
    Interval("0_20", 0, 20, "zone", "0_20"),
    Interval("0_30", 0, 30, "zone", "0_30"),
    Interval("0_100", 0, 100, "zone", "0_100"),
    Interval("0_150", 0, 150, "zone", "0_150"),
    Interval("0_profile", 0, None, "zone", "0_999"),
)

LABELS: tuple[str, ...] = tuple(i.label for i in INTERVALS)
WHOLE_PROFILE = "0_profile"
DEPTH = "depth_interval"

INTERVAL_SCHEMA = T.StructType(
    [
        T.StructField(DEPTH, T.StringType(), False),
        T.StructField("top_cm", T.IntegerType(), False),
        T.StructField("bottom_cm", T.IntegerType(), True),
        T.StructField("kind", T.StringType(), False),
        T.StructField("to_reported_profile_depth", T.BooleanType(), False),
        T.StructField("source_suffix", T.StringType(), False),
        T.StructField("idx", T.IntegerType(), False),
    ]
)


def interval_frame(spark: SparkSession) -> DataFrame:
    """The dimension as a DataFrame: always eleven rows."""
    rows = [(i.label, i.top_cm, i.bottom_cm, i.kind, i.open_ended, i.suffix, n) for n, i in enumerate(INTERVALS)]
    return spark.createDataFrame(rows, INTERVAL_SCHEMA)
