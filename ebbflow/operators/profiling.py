"""Column profiles: blanks, cardinalities, distributions, categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions import is_blank, percent
from ebbflow.operators.ranking import exact_quantiles

PROFILE_QUANTILES = {
    "p01": 0.01,
    "p05": 0.05,
    "p25": 0.25,
    "p50": 0.50,
    "p75": 0.75,
    "p90": 0.90,
    "p95": 0.95,
    "p99": 0.99,
    "p999": 0.999,
}


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Blank cells per column, worst first: one aggregation over all columns."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    blanks = [F.count_if(is_blank(F.col(c), types[c])).alias(c) for c in columns]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *blanks)
    long = counted.unpivot("n_rows", columns, "column_name", "n_blank")
    return long.withColumn("pct_blank", percent(F.col("n_blank"), F.col("n_rows"))).orderBy(
        F.col("n_blank").desc(), "column_name"
    )


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    Exact counting first groups by (column, value) over the whole cluster, so no task
    ever holds the values of a column. The sketch needs no shuffle of values at all.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], list(columns), "column_name", "value").filter(
        F.col("value").isNotNull()
    )
    if approximate:
        return long.groupBy("column_name").agg(F.approx_count_distinct("value").alias("n_distinct"))
    distinct = long.groupBy("column_name", "value").agg(F.lit(1).alias("_one"))
    return distinct.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample standard deviation, min and max per numeric column.

    All columns are aggregated side by side; only the one resulting row is turned into
    a row per column.
    """
    names = list(columns)
    summaries = []
    for name in names:
        v = F.col(name).cast("double")
        summary = F.struct(
            F.lit(name).alias("metric"),
            F.count(v).alias("n"),
            F.round(F.avg(v), 6).alias("mean"),
            F.round(F.stddev_samp(v), 6).alias("stddev"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
        )
        summaries.append(summary.alias(name))
    return df.agg(*summaries).select(F.inline(F.array(*names)))


def period_bounds(df: DataFrame, month: str = "month") -> DataFrame:
    """First and last month, months present and rows: one row."""
    per_month = df.groupBy(month).agg(F.count(F.lit(1)).alias("_n"))
    return per_month.agg(
        F.min(month).alias("first_month"),
        F.max(month).alias("last_month"),
        F.count(F.lit(1)).alias("n_months"),
        F.sum("_n").alias("n_rows"),
    )


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`describe` plus exact quantiles."""
    quantiles = exact_quantiles(df, columns, PROFILE_QUANTILES)
    return describe(df, columns).join(quantiles, "metric")


def category_profile(df: DataFrame, columns: Sequence[str], top: int = 3) -> DataFrame:
    """Per column its cardinality, its `top` values and its rarest value.

    The rank filters keep `top` rows per task before the shuffle, so a column of
    any cardinality is ranked without gathering its values.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        texts.unpivot([], list(columns), "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("_rows")
    )
    per_column = Window.partitionBy("column_name")
    most = per_column.orderBy(F.col("n").desc(), "value")
    least = per_column.orderBy("n", "value")
    best = counts.withColumn("position", F.row_number().over(most)).filter(F.col("position") <= top)
    rarest = counts.withColumn("position", F.row_number().over(least)).filter("position = 1")
    ranked = best.withColumn("kind", F.lit("top")).unionByName(
        rarest.withColumn("kind", F.lit("rarest"))
    )
    return ranked.join(totals, "column_name").select(
        "column_name",
        "n_values",
        "kind",
        "position",
        "value",
        "n",
        percent(F.col("n"), F.col("_rows")).alias("pct"),
    )


def crosstab(df: DataFrame, first: str, second: str, weight: str | None = None) -> DataFrame:
    """Counts per pair of values, largest first within `second`."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        df.groupBy(first, second)
        .agg(n.alias("n"))
        .orderBy(second, F.col("n").desc(), first)
    )
