"""Pixels to values: the star join, and joins that survive a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import column_of_x, encode_integer, nan_to_null, row_of_y
from ..model.intervals import DEPTH, INTERVALS, LABELS
from ..model.variables import INTEGER_RANGE, SPARK_TYPE, Variable
from ..sources.pixels import mapped

# A build side is broadcast only when its recorded number of rows shows that it stays below this.
BROADCAST_BYTES = 128 * 1024 * 1024
# A key is hot when it holds more than this share of the rows.
HOT_SHARE = 1 / 256


class LookupTableError(ValueError):
    """A value table that cannot serve as a lookup."""


def row_bytes(schema: T.StructType) -> int:
    """Generous size of one row of a value table: keys and numbers, arrays of one per interval."""
    size = 32
    for f in schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            size += 32 + 8 * len(INTERVALS)
        elif isinstance(f.dataType, T.StructType):
            size += 16 + 8 * len(f.dataType.fields)
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size += 256
        else:
            size += 8
    return size


def hot_keys(facts: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys holding more than ``share`` of the rows: never more than ``1 / share`` of them.

    Counted with map-side combination over one narrow column, so the hot keys
    themselves are no burden here.  A missing key is listed as None.
    """
    counts = facts.groupBy(key).agg(F.count("*").alias("n"))
    total = facts.count()
    return [r[0] for r in counts.where(F.col("n") > total * share).select(key).collect()]


def is_one_of(key: str, keys: Sequence) -> Column:
    """Null-safe membership; None among the keys stands for a missing key."""
    test = F.coalesce(F.col(key).isin([k for k in keys if k is not None]), F.lit(False))
    return test | F.col(key).isNull() if None in keys else test


def hot_among(counts: DataFrame, key: str, number: str, share: float = HOT_SHARE) -> list:
    """Keys above ``share`` of all rows, from stored counts per key instead of from the rows."""
    total = counts.agg(F.sum(number)).first()[0] or 0
    return [r[0] for r in counts.groupBy(key).agg(F.sum(number).alias("n")).where(F.col("n") > total * share).select(key).collect()]


def skew_safe_join(
    facts: DataFrame, values: DataFrame, key: str, *, how: str = "left", rows: int | None = None, hot: Sequence = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join many facts to one value row per key, whatever the key distribution; nothing is counted here.

    ``rows`` is the number of value rows as recorded when they were stored: if
    they are few enough, they are broadcast.  Otherwise the ``hot`` keys, of which
    there can be only ``1 / HOT_SHARE``, meet their values by broadcast and stay
    where they are; all other keys hold little each and are shuffled.  Both
    branches together are the whole join.  Without either, adaptive execution
    decides from the sizes it measures, and splits skewed partitions.
    """
    if how not in ("left", "inner"):
        raise LookupTableError(f"unsupported join type {how!r}")
    if rows is not None and rows * row_bytes(values.schema) <= broadcast_bytes:
        return facts.join(F.broadcast(values), key, how)
    if not hot:
        return facts.join(values, key, how)
    is_hot = is_one_of(key, hot)
    near = facts.where(is_hot).join(F.broadcast(values.where(is_hot)), key, how)
    far = facts.where(~is_hot).join(values.where(~is_hot), key, how)
    return near.unionByName(far)


def repeated_lookup_keys(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would multiply pixels; a sound lookup has none."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return values.where(present).groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def require_lookup(values: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """The rows with a key, once no key is found to repeat."""
    if not repeated_lookup_keys(values, keys).isEmpty():
        raise LookupTableError(f"{label}: lookup keys repeat")
    return values.dropna(subset=list(keys))


def encoded(v: Variable) -> Column:
    """A value in its storage type: null for a missing float, else the sentinel."""
    if v.fill is None:
        return nan_to_null(F.col(v.name).cast("double")).cast(SPARK_TYPE[v.dtype])
    low, high = INTEGER_RANGE[v.dtype]
    return encode_integer(F.col(v.name), low, high, v.fill, v.name).cast(SPARK_TYPE[v.dtype])


def lookup_table(values: DataFrame, v: Variable, depth: str | None = None) -> DataFrame:
    """(mukey, value) of one product, and of one interval when it has depth.

    Encoding happens here, once per map unit rather than once per pixel.
    """
    if v.by_depth != (depth is not None):
        raise LookupTableError(f"{v.name}: {'needs' if v.by_depth else 'has no'} depth interval")
    rows = values if depth is None else values.where(F.col(DEPTH) == depth)
    per_key = rows.where(F.col("mukey").isNotNull()).groupBy("mukey").agg(
        single(encoded(v), F.lit(True), v.name, SPARK_TYPE[v.dtype]).alias("value")
    )
    return per_key


def single(value: Column, here: Column, label: str, kind: T.DataType) -> Column:
    """Aggregate: the value of the one row marked ``here``; a second such row is an error.

    Checked inside the aggregate, so a repeated key can never multiply pixels
    and finding it costs no job of its own.
    """
    repeated = F.raise_error(F.lit(f"{label}: lookup keys repeat")).cast(kind)
    return F.when(F.count_if(here) <= 1, F.max(F.when(here, value))).otherwise(repeated)


def rasterize(
    pixels: DataFrame, values: DataFrame, v: Variable, depth: str | None = None, *, rows: int | None = None, hot: Sequence = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The value of one product at every mapped pixel.

    With a recorded number of value ``rows``, pixels are streamed through the join
    where they lie: no shuffle, no sort.  A key without a row gets the fill value, as background does by absence.
    """
    cells = mapped(pixels)
    if v.is_key:
        return cells.withColumn("value", F.col("mukey").cast(SPARK_TYPE[v.dtype]))
    found = skew_safe_join(cells, lookup_table(values, v, depth), "mukey", rows=rows, hot=hot, broadcast_bytes=broadcast_bytes)
    if v.fill is None:
        return found
    return found.withColumn("value", F.coalesce("value", F.lit(v.fill).cast(SPARK_TYPE[v.dtype])))


def expand(
    pixels: DataFrame, values: DataFrame, columns: Sequence[str], *, rows: int | None = None, hot: Sequence = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Several raw columns at once, for queries that need no encoding."""
    return skew_safe_join(mapped(pixels), values.select("mukey", *columns), "mukey", rows=rows, hot=hot, broadcast_bytes=broadcast_bytes)


def key_counts(pixels: DataFrame) -> DataFrame:
    """Mapped pixels per region and key."""
    return mapped(pixels).groupBy("region", "mukey").agg(F.count("*").alias("pixels"))


def unmatched_keys(pixels: DataFrame, values: DataFrame) -> DataFrame:
    """Pixel keys without a value row, with the pixels that carry them.

    Pixels are reduced to their distinct keys first; only those are joined.
    """
    keys = key_counts(pixels)
    return keys.join(values.select("mukey").distinct(), "mukey", "left_anti")


def unmatched_report(unmatched: DataFrame) -> DataFrame:
    """Number of unmatched keys; the keys themselves are ``unmatched`` and stay a table."""
    return unmatched.select("mukey").distinct().agg(F.count("*").alias("unmatched_mukey_count"))


def locate(points: DataFrame, regions: DataFrame) -> DataFrame:
    """Cell of each point given in its region's own coordinates; none outside the grid or in an unknown region."""
    cell = points.join(regions, "region", "left").select(
        *points.columns, "width", "height",
        row_of_y("y", F.col("y_max"), F.col("pixel_size")).alias("row_no"),
        column_of_x("x", F.col("x_min"), F.col("pixel_size")).alias("col_no"),
    )
    inside = (F.col("row_no") >= 0) & (F.col("col_no") >= 0) & (F.col("row_no") < F.col("height")) & (
        F.col("col_no") < F.col("width")
    )
    return cell.select(
        *points.columns, F.when(inside, F.col("row_no")).alias("row_no"), F.when(inside, F.col("col_no")).alias("col_no")
    )


def keys_at(points: DataFrame, pixels: DataFrame, regions: DataFrame) -> DataFrame:
    """One row per point with the map-unit key under it; null on background and outside."""
    return locate(points, regions).join(
        mapped(pixels).select("region", "row_no", "col_no", "mukey"), ["region", "row_no", "col_no"], "left"
    )


def depth_profiles(points: DataFrame, pixels: DataFrame, regions: DataFrame, soil: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All eleven intervals of the chosen products under each point; null where nothing is known."""
    labels = F.explode(F.array(*[F.lit(label) for label in LABELS])).alias(DEPTH)
    keyed = keys_at(points, pixels, regions).select("*", labels)
    return keyed.join(soil.select("mukey", DEPTH, *columns), ["mukey", DEPTH], "left")
