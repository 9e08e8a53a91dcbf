"""What happens to a cohort in the months after a reference month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions import guarded_ratio, month_label
from ebbflow.settings import CohortKeys, Outlook

COUNTS = ("n_total", "n_pos", "n_neg")


def forward_window(
    cohorts: DataFrame, keys: CohortKeys = CohortKeys(), outlook: Outlook = Outlook()
) -> DataFrame:
    """Add the counts of the next `horizon` calendar months of the same profile.

    A RANGE frame over the month ordinal: one shuffle on the profile, no join, and a
    missing month leaves a gap rather than pulling in a seventh month. A window
    partition holds one row per month of one profile. `cohorts` must be key-unique
    and hold every month, so right-censoring comes afterwards.
    """
    h = outlook.horizon
    ahead = Window.partitionBy(*keys.profile).orderBy(keys.time).rangeBetween(1, h)
    sums = {f"{c}_{h}m": F.coalesce(F.sum(c).over(ahead), F.lit(0)) for c in COUNTS}
    active = F.count(keys.time).over(ahead)
    return with_share(cohorts.withColumns({**sums, "months_active": active}), outlook)


def forward_window_join(
    cohorts: DataFrame, keys: CohortKeys = CohortKeys(), outlook: Outlook = Outlook()
) -> DataFrame:
    """The same by an equi-join, also right when `cohorts` is not key-unique.

    Each reference month is expanded to its `horizon` target months, so the join key
    includes the month and no profile-wide pairs arise.
    """
    h = outlook.horizon
    per_month = cohorts.groupBy(*keys.profile, keys.time).agg(*[F.sum(c).alias(c) for c in COUNTS])
    future = per_month.select(
        *keys.profile,
        F.col(keys.time).alias("_target"),
        *[F.col(c).alias(f"_{c}") for c in COUNTS],
    )
    targets = per_month.select(
        *keys.columns, F.explode(F.sequence(F.col(keys.time) + 1, F.col(keys.time) + h)).alias("_target")
    )
    joined = targets.join(future, [*keys.profile, "_target"], "left")
    summed = joined.groupBy(*keys.columns).agg(
        *[F.coalesce(F.sum(f"_{c}"), F.lit(0)).alias(f"{c}_{h}m") for c in COUNTS],
        F.count("_n_total").alias("months_active"),
    )
    return with_share(cohorts.join(summed, list(keys.columns)), outlook)


def with_share(df: DataFrame, outlook: Outlook = Outlook()) -> DataFrame:
    """Add `share_neg_<h>m` (0.0 for an empty future) and `has_future`."""
    h = outlook.horizon
    return df.withColumns(
        {
            f"share_neg_{h}m": guarded_ratio(F.col(f"n_neg_{h}m"), F.col(f"n_total_{h}m")),
            "has_future": F.col("months_active") > 0,
        }
    )


def last_month(df: DataFrame, time: str = "month_seq") -> F.Column:
    """Latest month in the data, as a scalar subquery."""
    return df.agg(F.max(time)).scalar()


def eligible(
    windowed: DataFrame, keys: CohortKeys = CohortKeys(), outlook: Outlook = Outlook()
) -> DataFrame:
    """Right-censoring: keep reference months whose whole horizon lies in the data.

    Adds `months_observed`: how many of the horizon's calendar months exist in the
    data at all (fewer than the horizon when a month was never delivered).
    """
    h = outlook.horizon
    kept = windowed.filter(F.col(keys.time) <= last_month(windowed, keys.time) - h)
    # one row per calendar month
    seen = windowed.select(keys.time).distinct()
    reach = F.explode(F.sequence(F.col(keys.time) - h, F.col(keys.time) - 1)).alias(keys.time)
    observed = seen.select(reach).groupBy(keys.time).agg(
        F.count(F.lit(1)).cast("int").alias("months_observed")
    )
    # one entry per calendar month, looked up in place: the windowed rows stay where they are
    entries = F.map_from_entries(F.collect_list(F.struct(keys.time, "months_observed")))
    calendar = observed.agg(entries).scalar()
    kept = kept.withColumn(
        "months_observed", F.coalesce(F.try_element_at(calendar, F.col(keys.time)), F.lit(0))
    )
    if outlook.require_complete_horizon:
        kept = kept.filter(F.col("months_observed") == h)
    return kept


def censoring_report(
    windowed: DataFrame, keys: CohortKeys = CohortKeys(), outlook: Outlook = Outlook()
) -> DataFrame:
    """Last month, last eligible reference month, cohorts kept and excluded: one row."""
    per_month = windowed.groupBy(keys.time).agg(F.count(F.lit(1)).alias("_n"))
    last = F.col("_last")
    with_last = per_month.withColumn("_last", per_month.agg(F.max(keys.time)).scalar())
    inside = F.col(keys.time) <= last - outlook.horizon
    report = with_last.groupBy("_last").agg(
        F.sum("_n").alias("cohorts_total"),
        F.sum(F.when(inside, F.col("_n")).otherwise(0)).alias("cohorts_eligible"),
    )
    excluded = F.col("cohorts_total") - F.col("cohorts_eligible")
    return report.select(
        month_label(last).alias("last_month"),
        month_label(last - outlook.horizon).alias("last_eligible_month"),
        "cohorts_total",
        "cohorts_eligible",
        excluded.alias("cohorts_excluded"),
        F.round(excluded / F.col("cohorts_total") * 100, 6).alias("pct_excluded"),
    )


def horizon_listing(
    months: DataFrame, outlook: Outlook = Outlook(), time: str = "month_seq"
) -> DataFrame:
    """For every reference month its future months, each marked available or not.

    `months` has one row per month (`records_per_month`, materialised).
    """
    seen = months.select(time)
    steps = seen.select(
        F.col(time), F.explode(F.sequence(F.lit(1), F.lit(outlook.horizon))).alias("step")
    ).withColumn("_future", F.col(time) + F.col("step"))
    known = seen.select(F.col(time).alias("_future"), F.lit(True).alias("_known"))
    return steps.join(known, "_future", "left").select(
        month_label(time).alias("month"),
        "step",
        F.when(F.col("_known"), month_label("_future")).otherwise("INDISPONIVEL").alias("future_month"),
        F.coalesce("_known", F.lit(False)).alias("available"),
    )
