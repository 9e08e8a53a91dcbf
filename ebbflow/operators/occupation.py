"""Which occupation dominates a cohort, and what that says about turnover."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions import percent
from ebbflow.operators.cohorts import signed_counts
from ebbflow.operators.labels import LABEL
from ebbflow.operators.ranking import exact_quantiles
from ebbflow.settings import CohortKeys

DOMINANCE_QUANTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}


def occupation_volume(
    movements: DataFrame, group: str = "occupation_group", top: int = 10
) -> DataFrame:
    """Entries, exits and total of the busiest groups."""
    counted = movements.groupBy(group).agg(*signed_counts())
    return counted.orderBy(F.col("n_total").desc(), group).limit(top)


def occupation_share(
    counts: DataFrame,
    keys: Sequence[str] = CohortKeys().columns,
    group: str = "occupation_group",
) -> DataFrame:
    """Count and share of each occupation group in its cohort.

    `counts` comes from `cohorts.fine_counts`, so a window partition holds one row per
    group in a cohort.
    """
    cohort = Window.partitionBy(*keys)
    counted = counts.select(*keys, group, F.col("n_total").alias("n_group"))
    return counted.withColumn("n_cohort", F.sum("n_group").over(cohort)).withColumn(
        "share", F.col("n_group") / F.col("n_cohort")
    )


def dominant_occupation(
    counts: DataFrame,
    keys: Sequence[str] = CohortKeys().columns,
    group: str = "occupation_group",
) -> DataFrame:
    """The most frequent group of each cohort; the lower code wins a tie."""
    shares = occupation_share(counts, keys, group)
    order = Window.partitionBy(*keys).orderBy(F.col("n_group").desc(), group)
    return shares.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def dominance_quantiles(dominant: DataFrame) -> DataFrame:
    return exact_quantiles(dominant, ["share"], DOMINANCE_QUANTILES)


def dominant_join(
    labelled: DataFrame, dominant: DataFrame, keys: Sequence[str] = CohortKeys().columns
) -> DataFrame:
    """Label and dominant occupation of each cohort, on the whole cohort key."""
    left = labelled.select(*keys, "n_total", LABEL)
    return left.join(dominant, list(keys))


def occupation_rate(
    joined: DataFrame,
    by: Sequence[str] = ("occupation_group",),
    min_cohorts: int = 50,
    top: int | None = 10,
) -> DataFrame:
    """Share of class-1 cohorts per occupation (and further columns), highest first.

    Groups with fewer than `min_cohorts` cohorts are left out; `top=None` keeps all.
    """
    rows = F.count(F.lit(1))
    rates = joined.groupBy(*by).agg(
        rows.alias("n_cohorts"),
        F.count_if(F.col(LABEL) == 1).alias("n_class_1"),
        F.count_if(F.col(LABEL) == 0).alias("n_class_0"),
        percent(F.count_if(F.col(LABEL) == 1), rows).alias("pct_class_1"),
        F.round(F.avg("share") * 100, 6).alias("mean_share_pct"),
        F.sum("n_total").alias("volume"),
    )
    supported = rates.filter(F.col("n_cohorts") >= min_cohorts)
    ordered = supported.orderBy(F.col("pct_class_1").desc(), *by)
    return ordered if top is None else ordered.limit(top)


def join_fanout_audit(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What an inner join on `keys` would do, without doing it: one row.

    Both sides are counted per key and joined on the counts, so a key that would
    multiply into billions of pairs is one row here.
    """
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_r"))
    both = a.join(b, list(keys), "full_outer").select(
        F.coalesce("_l", F.lit(0)).alias("l"), F.coalesce("_r", F.lit(0)).alias("r")
    )
    pairs = F.sum(F.col("l") * F.col("r"))
    return both.agg(
        F.sum("l").alias("rows_left"),
        F.sum("r").alias("rows_right"),
        pairs.alias("rows_joined"),
        F.sum(F.when(F.col("r") == 0, F.col("l")).otherwise(0)).alias("rows_left_unmatched"),
        F.max("r").alias("max_matches_per_row"),
        (pairs > F.sum(F.when(F.col("r") > 0, F.col("l")).otherwise(0))).alias("multiplies"),
    )
