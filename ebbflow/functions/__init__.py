"""Column-level helpers: every function maps Columns to a Column."""

from ebbflow.functions.bands import age_band, leading_digits, salary_band, stepped_band, volume_band
from ebbflow.functions.months import month_label, month_number, month_ordinal, year_number
from ebbflow.functions.numbers import guarded_ratio, hash_percent, is_blank, percent, to_double, to_int

__all__ = [
    "age_band",
    "guarded_ratio",
    "hash_percent",
    "is_blank",
    "leading_digits",
    "month_label",
    "month_number",
    "month_ordinal",
    "percent",
    "salary_band",
    "stepped_band",
    "to_double",
    "to_int",
    "volume_band",
    "year_number",
]
