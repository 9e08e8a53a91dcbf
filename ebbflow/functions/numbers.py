"""Number parsing and arithmetic that never raises on dirty input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# digits with an optional sign, fraction and exponent; no type suffixes, NaN or Infinity
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_double(text: Column, thousands_sep: str | None = None) -> Column:
    """Number written with a decimal comma; null when it is not a number.

    `1.412,50` is null unless `thousands_sep="."` is given.
    """
    if thousands_sep:
        text = F.replace(text, F.lit(thousands_sep), F.lit(""))
    number = F.trim(F.translate(text, ",", "."))
    return F.when(number.rlike(NUMBER), number.try_cast("double"))


def to_int(text: Column) -> Column:
    """Integer part of a number written as text; null when it is not a number."""
    return to_double(text.cast("string")).try_cast("int")


def guarded_ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0.0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 6) -> Column:
    return F.round(guarded_ratio(part, whole) * 100, digits)


def is_blank(column: Column, data_type: str = "string") -> Column:
    """Null, empty after trimming (text) or NaN (floating point)."""
    if data_type in ("double", "float"):
        return column.isNull() | F.isnan(column)
    if data_type == "string":
        return column.isNull() | (F.trim(column) == "")
    return column.isNull()


def hash_percent(columns: list[Column], seed: int = 42) -> Column:
    """A stable number 0..99 per key, whatever the partitioning.

    First eight hex digits of the md5 of the key and the seed, modulo 100.
    """
    key = F.concat_ws("|", *[c.cast("string") for c in columns], F.lit(str(seed)))
    digest = F.conv(F.substring(F.md5(key), 1, 8), 16, 10)
    return (digest.cast("bigint") % 100).cast("int")
