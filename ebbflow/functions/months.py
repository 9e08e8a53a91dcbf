"""Months as `YYYYMM` labels and as integer ordinals (`year * 12 + month`).

The ordinal is the working form: it is an integer, so it can order a RANGE frame
and costs less than a string as a grouping key. Labels are made at the edges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_ordinal(label: Column | str) -> Column:
    """Ordinal of a `YYYYMM` label; null unless it is six digits with a month from 1 to 12."""
    text = F.trim(_as_column(label).cast("string"))
    ordinal = F.substring(text, 1, 4).try_cast("int") * 12 + F.substring(text, 5, 2).try_cast("int")
    return F.when(text.rlike(r"^\d{4}(0[1-9]|1[0-2])$"), ordinal)


def year_number(ordinal: Column | str) -> Column:
    return F.floor((_as_column(ordinal) - 1) / 12).cast("int")


def month_number(ordinal: Column | str) -> Column:
    return ((_as_column(ordinal) - 1) % 12 + 1).cast("int")


def month_label(ordinal: Column | str) -> Column:
    """`YYYYMM` label of an ordinal."""
    return (year_number(ordinal) * 100 + month_number(ordinal)).cast("string")
