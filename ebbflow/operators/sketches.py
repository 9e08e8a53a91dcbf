"""Quantiles and distinct counts from sketches that are stored by month and merged on demand.

A month's rows are read once, when they arrive; any set of months is then answered from
sketches of a few kilobytes. A month that is delivered again replaces its own sketches.
Quantile sketches (KLL) have a rank error that depends on their size alone; distinct
sketches (HLL) count exactly while few values are held and then with a relative error of
about 1.04 / sqrt(2 ^ bits).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.sources import sinks

KLL_SIZE = 800  # kept items in a sketch's last level; a rank is off by under 0.4 % of the rows
RANK_ERROR = 0.01  # what is promised for a merged sketch, above the 99 % bound at that size
HLL_BITS = 16
DISTINCT_ERROR = 0.02  # five times the standard error of 2^16 registers


def month_sketches(
    df: DataFrame, numbers: Sequence[str], categories: Sequence[str], month: str = "month"
) -> DataFrame:
    """(month, column_name, n, quantiles, distinct): one row per month and column.

    `quantiles` sketches a number's values, `distinct` any column's; nulls are in neither.
    One aggregation with partial sketches: what is shuffled is a sketch for each task,
    month and column, however many rows a month has.
    """
    texts = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"), F.col(c).cast("string").alias("v")) for c in numbers]
    texts += [F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("double").alias("x"), F.col(c).cast("string").alias("v")) for c in categories]
    long = df.select(F.col(month).alias("month"), F.explode(F.array(*texts)).alias("s")).select("month", "s.*")
    return long.groupBy("month", "column_name").agg(
        F.count("v").alias("n"),
        F.kll_sketch_agg_double("x", F.lit(KLL_SIZE)).alias("quantiles"),
        F.hll_sketch_agg("v", F.lit(HLL_BITS)).alias("distinct"),
    )


def store_sketches(sketches: DataFrame, base: str, months: Sequence[str] = ()) -> None:
    """Replace the sketches of the months present (and of `months`) below `base`, no others."""
    sinks.write_months(sketches, base, rebalance=True, months=months)


def read_sketches(spark: SparkSession, base: str, months: Sequence[str] | None = None) -> DataFrame:
    rows = sinks.read_table(spark, base)
    return rows if months is None else rows.filter(F.col("competencia").cast("string").isin(*months))


def merged_quantiles(sketches: DataFrame, quantiles: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., metric, n, one column per quantile) over all months in `sketches`.

    Each value is one that occurs, and its share of rows at or below lies within
    RANK_ERROR of the probability. Columns without a number have no row.
    """
    merged = sketches.filter("quantiles is not null").groupBy(*by, F.col("column_name").alias("metric"))
    merged = merged.agg(F.kll_merge_agg_double("quantiles").alias("_s"))
    merged = merged.withColumn("n", F.kll_sketch_get_n_double("_s")).filter("n > 0")
    found = [F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias(name) for name, p in quantiles.items()]
    return merged.select(*by, "metric", "n", *found)


def merged_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., column_name, n_distinct) over all months in `sketches`, off by DISTINCT_ERROR at most."""
    merged = sketches.groupBy(*by, "column_name").agg(F.hll_union_agg("distinct").alias("_s"))
    return merged.select(*by, "column_name", F.hll_sketch_estimate("_s").alias("n_distinct"))


def rank_error(df: DataFrame, metric: str, value: Column, probability: float) -> Column:
    """How far the share of rows at or below `value` is from the probability, ties counted as reached.

    An aggregate over `df`: zero if the probability lies between the shares below and at the value.
    """
    n = F.count(metric)
    below, at = F.count_if(F.col(metric) < value) / n, F.count_if(F.col(metric) <= value) / n
    p = F.lit(probability)
    return F.greatest(below - p, p - at, F.lit(0.0))
