"""Turning the forward share into a binary label, and auditing it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions import guarded_ratio, percent
from ebbflow.operators.ranking import exact_quantiles
from ebbflow.operators.splits import hash_part
from ebbflow.settings import CohortKeys, Outlook

LABEL = "high_turnover"

INDICATOR_QUANTILES = {
    "p10": 0.10,
    "p25": 0.25,
    "p50": 0.50,
    "p75": 0.75,
    "p90": 0.90,
    "p95": 0.95,
    "p99": 0.99,
}


def indicator(outlook: Outlook = Outlook()) -> str:
    return f"share_neg_{outlook.horizon}m"


def indicator_quantiles(
    cohorts: DataFrame,
    outlook: Outlook = Outlook(),
    quantiles: Mapping[str, float] = INDICATOR_QUANTILES,
) -> DataFrame:
    return exact_quantiles(cohorts, [indicator(outlook)], dict(quantiles))


def threshold(
    cohorts: DataFrame,
    keys: CohortKeys = CohortKeys(),
    outlook: Outlook = Outlook(),
) -> Column:
    """The cut point as a scalar subquery."""
    base = cohorts
    if outlook.threshold_scope == "train":
        base = hash_part(cohorts, keys.columns).filter(F.col("part") == "train")
    wanted = {"cut": outlook.threshold_quantile}
    cut = exact_quantiles(base, [indicator(outlook)], wanted)
    return cut.select("cut").scalar()


def with_label(
    cohorts: DataFrame,
    keys: CohortKeys = CohortKeys(),
    outlook: Outlook = Outlook(),
) -> DataFrame:
    """Class 1 strictly above the threshold; ties are class 0."""
    above = F.col(indicator(outlook)) > threshold(cohorts, keys, outlook)
    return cohorts.withColumn(LABEL, F.when(above, 1).otherwise(0))


def threshold_ties(
    cohorts: DataFrame,
    keys: CohortKeys = CohortKeys(),
    outlook: Outlook = Outlook(),
) -> DataFrame:
    """How many cohorts sit exactly on the threshold: one row."""
    cut = threshold(cohorts, keys, outlook)
    marked = cohorts.select((F.col(indicator(outlook)) == cut).alias("_tie"), cut.alias("_cut"))
    return marked.agg(
        F.max("_cut").alias("threshold"),
        F.count(F.lit(1)).alias("n_cohorts"),
        F.count_if("_tie").alias("n_ties"),
        percent(F.count_if("_tie"), F.count(F.lit(1))).alias("pct_ties"),
    )


def class_counts(label: str = LABEL) -> list[Column]:
    """Aggregates every class-rate report shares."""
    rows = F.count(F.lit(1))
    return [
        rows.alias("n_cohorts"),
        F.count_if(F.col(label) == 0).alias("n_class_0"),
        F.count_if(F.col(label) == 1).alias("n_class_1"),
        percent(F.count_if(F.col(label) == 0), rows).alias("pct_class_0"),
        percent(F.count_if(F.col(label) == 1), rows).alias("pct_class_1"),
    ]


def class_distribution(labelled: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, n, pct). The total is a window over the class rows, not a second count."""
    per_class = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n_cohorts"))
    total = F.sum("n_cohorts").over(Window.partitionBy())
    return per_class.withColumn("pct", percent(F.col("n_cohorts"), total))


def label_stability(
    labelled: DataFrame, dimensions: Mapping[str, Column], label: str = LABEL
) -> DataFrame:
    """Class shares along several dimensions in one aggregation.

    Rows (dimension, member, counts and shares), by GROUPING SETS.
    """
    names = list(dimensions)
    keyed = labelled.select(F.col(label), *[c.cast("string").alias(n) for n, c in dimensions.items()])
    sets = keyed.groupingSets([[n] for n in names], *names).agg(
        *class_counts(label), *[F.grouping(n).alias(f"_{n}") for n in names]
    )
    which = F.coalesce(*[F.when(F.col(f"_{n}") == 0, n) for n in names])
    member = F.coalesce(*[F.when(F.col(f"_{n}") == 0, F.col(n)) for n in names])
    return sets.select(
        which.alias("dimension"),
        member.alias("member"),
        "n_cohorts",
        "n_class_0",
        "n_class_1",
        "pct_class_0",
        "pct_class_1",
    )


def rate_by(labelled: DataFrame, dimension: Column, name: str, label: str = LABEL) -> DataFrame:
    return labelled.groupBy(dimension.alias(name)).agg(*class_counts(label))


def future_columns(outlook: Outlook = Outlook()) -> tuple[str, ...]:
    """Columns that look past the reference month; never features."""
    h = outlook.horizon
    return (
        f"n_total_{h}m",
        f"n_pos_{h}m",
        f"n_neg_{h}m",
        indicator(outlook),
        "months_active",
        "months_observed",
        "has_future",
    )


def modelling_table(labelled: DataFrame, keys: CohortKeys = CohortKeys()) -> DataFrame:
    """Key, counts at the reference month and the label: nothing from the future."""
    return labelled.select("month", *keys.columns, "n_total", "n_pos", "n_neg", LABEL)


def indicator_histogram(
    cohorts: DataFrame, outlook: Outlook = Outlook(), bins: int = 50
) -> DataFrame:
    """Equal-width bins between the smallest and largest indicator, empty bins included."""
    name = indicator(outlook)
    bounds = cohorts.agg(
        F.struct(F.min(name).alias("low"), F.max(name).alias("high")).alias("b")
    ).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    position = guarded_ratio((F.col(name) - low) * bins, high - low)
    counted = (
        cohorts.select(F.least(F.floor(position), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n_cohorts"))
    )
    spark = cohorts.sparkSession
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counted, "bin", "left").select(
        "bin", F.coalesce("n_cohorts", F.lit(0)).alias("n_cohorts")
    )
