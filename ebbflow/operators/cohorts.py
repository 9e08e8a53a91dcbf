"""Counting movements per cohort, and judging the cohort key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.functions import month_label, percent
from ebbflow.operators.ranking import exact_quantiles
from ebbflow.settings import KEY_LADDER, CohortKeys

SIZE_QUANTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}


def signed_counts() -> list:
    return [
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("balance") == 1).alias("n_pos"),
        F.count_if(F.col("balance") == -1).alias("n_neg"),
    ]


def cohort_month(movements: DataFrame, keys: CohortKeys = CohortKeys()) -> DataFrame:
    """Entries, exits and total per cohort and month.

    Partial aggregation runs before the shuffle, so what is exchanged is at most
    one row per task and cohort however many movements a cohort has.
    """
    counted = movements.groupBy(*keys.columns).agg(*signed_counts())
    return counted.withColumn("month", month_label(keys.time))


def fine_counts(
    movements: DataFrame, extra: Sequence[str], keys: CohortKeys = CohortKeys()
) -> DataFrame:
    """The same counts per cohort and `extra` column values.

    One pass over the movements can then serve several coarser questions, see `roll_up`.
    """
    return movements.groupBy(*keys.columns, *extra).agg(*signed_counts())


def roll_up(counts: DataFrame, keys: CohortKeys = CohortKeys()) -> DataFrame:
    """`cohort_month` from finer counts."""
    summed = counts.groupBy(*keys.columns).agg(
        *[F.sum(c).alias(c) for c in ("n_total", "n_pos", "n_neg")]
    )
    return summed.withColumn("month", month_label(keys.time))


def cohort_sizes(
    movements: DataFrame, ladder: Mapping[str, Sequence[str]] = KEY_LADDER
) -> DataFrame:
    """(cohort_key, n_total, n_cohorts): the size histogram of nested keys.

    The finest key is counted from the movements; each coarser key rolls up the
    counts of the next finer one.
    """
    finest_first = sorted(ladder.items(), key=lambda item: -len(item[1]))
    for (_, finer), (name, key) in zip(finest_first, finest_first[1:]):
        if not set(key) <= set(finer):
            raise ValueError(f"key {name} does not nest in {tuple(finer)}")
    histograms = []
    counts = movements.withColumn("_n", F.lit(1).cast("bigint"))
    for name, key in finest_first:
        counts = counts.groupBy(*key).agg(F.sum("_n").alias("_n"))
        histogram = counts.groupBy(F.col("_n").alias("n_total")).agg(
            F.count(F.lit(1)).alias("n_cohorts")
        )
        histograms.append(histogram.select(F.lit(name).alias("cohort_key"), "*"))
    return reduce(DataFrame.unionByName, histograms)


def cohort_granularity(
    sizes: DataFrame,
    below: Sequence[int] = (10, 20, 50, 100),
    at_least: Sequence[int] = (20, 50),
) -> DataFrame:
    """Per key: cohorts, mean size, size quantiles, shares of small and large cohorts.

    `sizes` is what `cohort_sizes` returns. It is read twice here and holds one row per
    distinct size, so materialise it first.
    """
    cohorts = F.sum("n_cohorts")

    def share(condition) -> F.Column:
        return percent(F.sum(F.when(condition, F.col("n_cohorts")).otherwise(0)), cohorts)

    summary = sizes.groupBy("cohort_key").agg(
        cohorts.alias("n_cohorts"),
        F.round(F.sum(F.col("n_total") * F.col("n_cohorts")) / cohorts, 6).alias("mean_size"),
        *[share(F.col("n_total") < t).alias(f"pct_below_{t}") for t in below],
        *[share(F.col("n_total") >= t).alias(f"pct_from_{t}") for t in at_least],
    )
    quantiles = exact_quantiles(
        sizes, ["n_total"], SIZE_QUANTILES, by=["cohort_key"], weight="n_cohorts"
    ).drop("metric")
    return summary.join(quantiles, "cohort_key")


def threshold_simulation(cohorts: DataFrame, thresholds: Sequence[int]) -> DataFrame:
    """What each minimum cohort size would keep: one pass, one row per threshold."""
    kept = [F.count_if(F.col("n_total") >= t).alias(f"c{t}") for t in thresholds]
    rows = [
        F.sum(F.when(F.col("n_total") >= t, F.col("n_total")).otherwise(0)).alias(f"r{t}")
        for t in thresholds
    ]
    totals = cohorts.agg(
        F.count(F.lit(1)).alias("cohorts_before"), F.sum("n_total").alias("rows_before"), *kept, *rows
    )
    per_threshold = F.array(
        *[
            F.struct(
                F.lit(t).alias("min_size"),
                F.col(f"c{t}").alias("cohorts_after"),
                F.col(f"r{t}").alias("rows_kept"),
            )
            for t in thresholds
        ]
    )
    removed = F.col("cohorts_before") - F.col("cohorts_after")
    return totals.select("cohorts_before", "rows_before", F.inline(per_threshold)).select(
        "min_size",
        "cohorts_before",
        "cohorts_after",
        percent(removed, F.col("cohorts_before")).alias("pct_cohorts_removed"),
        "rows_kept",
        percent(F.col("rows_kept"), F.col("rows_before")).alias("pct_rows_kept"),
    )


def records_per_month(movements: DataFrame) -> DataFrame:
    counted = movements.groupBy("month_seq").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(month_label("month_seq").alias("month"), "month_seq", "n_rows")


def month_coverage(
    counts: DataFrame, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Every calendar month between the bounds with its rows and whether it is present.

    `counts` is what `records_per_month` returns; it is read twice, so materialise it
    first. Bounds default to the first and last month seen.
    """
    bounds = counts.agg(
        (F.lit(first) if first else F.min("month_seq")).alias("first"),
        (F.lit(last) if last else F.max("month_seq")).alias("last"),
    )
    calendar = bounds.select(F.explode(F.sequence("first", "last")).alias("month_seq"))
    found = counts.select("month_seq", "n_rows")
    return calendar.join(found, "month_seq", "left").select(
        month_label("month_seq").alias("month"),
        "month_seq",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.col("n_rows").isNotNull().alias("present"),
    )


def missing_months(
    counts: DataFrame, first: int | None = None, last: int | None = None
) -> DataFrame:
    return month_coverage(counts, first, last).filter(~F.col("present")).select("month")


def region_year_counts(
    movements: DataFrame, labels: DataFrame, weight: str | None = None
) -> DataFrame:
    """Rows per region and year with totals; null region or year marks a total.

    `labels` (region, region_name) is joined after counting. With `weight` the input
    is already counted.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counted = (
        movements.groupBy("month_seq", "region")
        .agg(n.alias("_n"))
        .withColumn("year", F.floor((F.col("month_seq") - 1) / 12).cast("int"))
        .cube("region", "year")
        .agg(F.sum("_n").alias("n_rows"))
    )
    return counted.join(labels, "region", "left").select("region", "region_name", "year", "n_rows")


def region_year_table(movements: DataFrame, years: Sequence[int]) -> DataFrame:
    """The same as a wide table, one column per year; naming the years saves a job."""
    year = F.floor((F.col("month_seq") - 1) / 12).cast("int")
    wide = movements.withColumn("year", year).groupBy("region").pivot("year", list(years)).count()
    filled = wide.na.fill(0)
    total = reduce(lambda a, b: a + b, [F.col(str(y)) for y in years])
    return filled.withColumn("total", total)
