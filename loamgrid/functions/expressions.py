"""Column expressions whose null and rounding rules the operators depend on."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "all_present", "clamp", "close_enough", "column_of_x", "date_in_name", "default_text", "encode_integer",
    "half_even", "nan_to_null", "phrase_in", "ratio", "row_of_y", "tidy_token", "word_in", "x_centre", "y_centre",
    "zero_if_empty",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_present(columns: Iterable[Column | str]) -> Column:
    """True where every column has a value: one mask shared by several columns."""
    return reduce(lambda a, b: a & b, [_col(c).isNotNull() for c in columns])


def clamp(value: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high].  Null stays null, although ``least`` would skip it."""
    value = _col(value)
    bounded = value
    if high is not None:
        bounded = F.least(bounded, F.lit(float(high)))
    if low is not None:
        bounded = F.greatest(bounded, F.lit(float(low)))
    return F.when(value.isNotNull(), bounded)


def zero_if_empty(total: Column) -> Column:
    """A sum that is zero, not null, when nothing was added."""
    return F.coalesce(total, F.lit(0.0))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient that is null where the denominator is zero or null."""
    return F.try_divide(_col(numerator), _col(denominator))


def half_even(value: Column | str) -> Column:
    """Round to a whole number, ties to the even neighbour."""
    return F.bround(_col(value), 0)


def nan_to_null(value: Column | str) -> Column:
    """NaN would sort above every number and pass every upper-bound test."""
    value = _col(value)
    return F.when(~F.isnan(value), value)


def default_text(value: Column | str, default: str = "") -> Column:
    return F.coalesce(_col(value), F.lit(default))


def phrase_in(value: Column | str, phrases: Iterable[str]) -> Column:
    """Case-insensitive substring test against any phrase; null counts as no text."""
    return default_text(value).rlike("(?i)(" + "|".join(phrases) + ")")


def word_in(value: Column | str, word: str) -> Column:
    """Case-insensitive whole-word test, singular or plural."""
    return default_text(value).rlike(rf"(?i)\b{word}s?\b")


def date_in_name(name: Column | str) -> Column:
    """ISO date from the first MM_DD_YYYY token of a name, null when it is no date."""
    name = _col(name)
    month, day, year = (F.regexp_extract(name, r"(\d{2})_(\d{2})_(\d{4})", g) for g in (1, 2, 3))
    legal = month.between("01", "12") & day.between("01", "31")
    return F.when(legal, F.concat_ws("-", year, month, day))


def tidy_token(name: Column | str) -> Column:
    """Lower-case token of letters, digits and single underscores; never empty."""
    joined = F.regexp_replace(_col(name), "[^0-9a-zA-Z]+", "_")
    trimmed = F.lower(F.regexp_replace(joined, "^_+|_+$", ""))
    return F.coalesce(F.nullif(trimmed, F.lit("")), F.lit("unknown"))


def encode_integer(value: Column | str, low: int, high: int, fill: int, label: str) -> Column:
    """Whole number in [low, high] with a sentinel for missing; anything else is an error."""
    whole = F.bround(nan_to_null(_col(value).cast("double")), 0).try_cast("bigint")
    filled = F.coalesce(whole, F.lit(fill).cast("bigint"))
    message = F.concat(F.lit(f"{label}: value outside {low}..{high}: "), filled.cast("string"))
    return F.when(filled.between(low, high), filled).otherwise(F.raise_error(message).cast("bigint"))


def x_centre(column: Column | str, x_min: Column, pixel_size: Column) -> Column:
    return x_min + (_col(column) + 0.5) * pixel_size


def y_centre(row: Column | str, y_max: Column, pixel_size: Column) -> Column:
    return y_max - (_col(row) + 0.5) * pixel_size


def column_of_x(x: Column | str, x_min: Column, pixel_size: Column) -> Column:
    """Column whose cell holds x, which is the cell with the nearest centre."""
    return F.floor((_col(x) - x_min) / pixel_size).cast("int")


def row_of_y(y: Column | str, y_max: Column, pixel_size: Column) -> Column:
    return F.floor((y_max - _col(y)) / pixel_size).cast("int")


def close_enough(a: Column | str, b: Column | str, relative: float = 1e-6, absolute: float = 1e-5) -> Column:
    """Equal within tolerance; missing equals missing and nothing else."""
    a, b = nan_to_null(_col(a).cast("double")), nan_to_null(_col(b).cast("double"))
    allowed = F.greatest(F.lit(relative) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))
    both = F.coalesce(F.abs(a - b) <= allowed, F.lit(False))
    return (a.isNull() & b.isNull()) | both
