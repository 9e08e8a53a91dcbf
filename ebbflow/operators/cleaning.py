"""Raw text rows to valid typed movements."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.functions import month_ordinal, to_double, to_int


# columns that not every delivery has
EXTRA = (
    ("municipality", lambda c: c.cast("string")),
    ("movement_type", to_int),
    ("contract_hours", to_double),
)


def typed(raw: DataFrame, thousands_sep: str | None = None, keep: Iterable[str] = ()) -> DataFrame:
    """Cast conformed raw columns; anything unreadable becomes null. `keep` goes through as it is."""
    return raw.select(
        F.col("month").cast("string").alias("month"),
        month_ordinal("month").alias("month_seq"),
        to_int(F.col("region")).alias("region"),
        F.nullif(F.trim("section"), F.lit("")).alias("section"),
        to_int(F.col("age")).alias("age"),
        to_int(F.col("schooling")).alias("schooling"),
        F.col("occupation").cast("string").alias("occupation"),
        to_int(F.col("sex")).alias("sex"),
        to_double(F.col("salary"), thousands_sep).alias("salary"),
        to_int(F.col("balance")).alias("balance"),
        to_int(F.col("category")).alias("category"),
        *[as_type(F.col(c)).alias(c) for c, as_type in EXTRA if c in raw.columns],
        *keep,
    )


def in_regions(df: DataFrame, codes: Iterable[int] | None, region: str = "region") -> DataFrame:
    """Keep the given regions. On typed Parquet the predicate reaches the scan."""
    return df if codes is None else df.filter(F.col(region).isin(*codes))


def month_of(df: DataFrame) -> Column:
    """The month ordinal of a row, read from its label where there is no ordinal column."""
    return F.col("month_seq") if "month_seq" in df.columns else month_ordinal("month")


def rejection_reason(month: Column) -> Column:
    """Why a row is not a movement; null for a valid one."""
    return (
        F.when(month.isNull(), "month")
        .when(F.col("region").isNull(), "region")
        .when(F.col("section").isNull(), "section")
        .when(F.col("balance").isNull() | ~F.col("balance").isin(1, -1), "balance")
    )


def is_valid(month: Column) -> Column:
    return (
        month.isNotNull()
        & F.col("region").isNotNull()
        & F.col("section").isNotNull()
        & F.col("balance").isin(1, -1)
    )


def valid_movements(df: DataFrame) -> DataFrame:
    return df.filter(is_valid(month_of(df)))


def rejected_counts(df: DataFrame) -> DataFrame:
    """Rows per rejection reason, valid rows included."""
    reason = F.coalesce(rejection_reason(month_of(df)), F.lit("valid"))
    return df.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
