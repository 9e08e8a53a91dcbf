"""Data tests a user runs between layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions import percent
from ebbflow.operators.labels import future_columns
from ebbflow.settings import FeatureSet, Outlook


class ExpectationError(AssertionError):
    """A gate did not hold."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count (empty when the key is unique)."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and duplicates: one row."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        (F.sum("n") - F.count(F.lit(1))).alias("n_duplicates"),
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    if not duplicate_keys(df, keys).isEmpty():
        raise ExpectationError(f"key {tuple(keys)} is not unique")
    return df


def require_rows(
    df: DataFrame, exactly: int | None = None, at_least: int | None = None
) -> DataFrame:
    """A pinned row count or a minimum volume."""
    n = df.count()
    if exactly is not None and n != exactly:
        raise ExpectationError(f"expected {exactly} rows, found {n}")
    if at_least is not None and n < at_least:
        raise ExpectationError(f"expected at least {at_least} rows, found {n}")
    return df


def require_no_leakage(features: FeatureSet, outlook: Outlook = Outlook()) -> None:
    leaking = sorted(set(features.columns) & {*future_columns(outlook), features.label})
    if leaking:
        raise ExpectationError(f"features look into the future: {leaking}")


def leakage_audit(
    table: DataFrame, allowed: Sequence[str], label: str, outlook: Outlook = Outlook()
) -> DataFrame:
    """Every column of a table: its role, whether it may be a feature, its filled cells.

    Roles: `feature` (in `allowed`), `label`, `future` (see `future_columns`) or
    `other`. A column is a leak when it is a future column or the label and yet allowed.
    """
    future = set(future_columns(outlook))
    filled = table.agg(*[F.count(c).alias(c) for c in table.columns])
    long = filled.unpivot([], table.columns, "column_name", "n_filled")
    name = F.col("column_name")
    hidden = name.isin(*future, label)
    role = (
        F.when(name == label, "label")
        .when(name.isin(*future), "future")
        .when(name.isin(*allowed), "feature")
        .otherwise("other")
    )
    return long.select(
        "column_name", role.alias("role"), (hidden & name.isin(*allowed)).alias("leak"), "n_filled"
    )


def schema_diff(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, columns, and each column no other table has.

    One row per (table, exclusive column); a table without any has a null there.
    """
    reports = []
    for name, df in tables.items():
        others = {c for other, d in tables.items() if other != name for c in d.columns}
        exclusive = sorted(set(df.columns) - others) or [None]
        counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
        reports.append(
            counted.select(
                F.lit(name).alias("table_name"),
                "n_rows",
                F.lit(len(df.columns)).alias("n_columns"),
                F.explode(F.array(*[F.lit(c).cast("string") for c in exclusive])).alias(
                    "exclusive_column"
                ),
            )
        )
    return reduce(DataFrame.unionByName, reports)


def stage_counts(df: DataFrame, stages: Mapping[str, Column | None], first: int = 1) -> DataFrame:
    """Rows (step, stage, rows_after) for several filters of one table, in one pass.

    `None` stands for all rows.
    """
    names = list(stages)
    counts = [
        (F.count(F.lit(1)) if kept is None else F.count_if(kept)).alias(name)
        for name, kept in stages.items()
    ]
    steps = [
        F.struct(F.lit(i).alias("step"), F.lit(n).alias("stage"), F.col(n).alias("rows_after"))
        for i, n in enumerate(names, first)
    ]
    return df.agg(*counts).select(F.inline(F.array(*steps)))


def attrition(counts: DataFrame, minimum: int = 500_000) -> DataFrame:
    """Rows before and after each step, and whether enough are left.

    `counts` (see `stage_counts`) has one row per step; the first step has itself as
    its predecessor.
    """
    previous = F.lag("rows_after").over(Window.partitionBy().orderBy("step"))
    before = F.coalesce("_before", "rows_after")
    return counts.withColumn("_before", previous).select(
        "step",
        "stage",
        before.alias("rows_before"),
        "rows_after",
        (before - F.col("rows_after")).alias("rows_removed"),
        percent(F.col("rows_after"), before).alias("pct_kept"),
        (F.col("rows_after") >= minimum).alias("enough_rows"),
    )
