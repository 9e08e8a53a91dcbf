"""Train/test splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions import hash_percent, percent


def hash_part(
    df: DataFrame, keys: Sequence[str], train_percent: int = 70, seed: int = 42
) -> DataFrame:
    """Add `part`, decided by the key alone.

    Unlike `randomSplit` the result does not depend on row order or partitioning, so
    a retried task or another cluster size gives the same split.
    """
    bucket = hash_percent([F.col(k) for k in keys], seed)
    return df.withColumn("part", F.when(bucket < train_percent, "train").otherwise("test"))


def hash_sample(df: DataFrame, keys: Sequence[str], percent_kept: int, seed: int = 42) -> DataFrame:
    """A repeatable Bernoulli sample."""
    return df.filter(hash_percent([F.col(k) for k in keys], seed) < percent_kept)


def random_parts(df: DataFrame, train_share: float = 0.7, seed: int = 42) -> DataFrame:
    """`randomSplit` as a `part` column; depends on the physical layout."""
    train, test = df.randomSplit([train_share, 1 - train_share], seed=seed)
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


def temporal_part(
    df: DataFrame, test_months: int = 12, embargo: int = 6, time: str = "month_seq"
) -> DataFrame:
    """Last `test_months` months to test, an embargo before them, the rest to train.

    The embargo is the horizon: without it the label windows of the last training
    months would reach into the test period.
    """
    first_test = df.agg(F.max(time) - test_months + 1).scalar()
    month = F.col(time)
    part = (
        F.when(month >= first_test, "test")
        .when(month >= first_test - embargo, "embargo")
        .otherwise("train")
    )
    return df.withColumn("part", part)


def split_report(parts: DataFrame, label: str = "high_turnover") -> DataFrame:
    """Rows, share of all rows and class shares per part."""
    rows = F.count(F.lit(1))
    per_part = parts.groupBy("part").agg(
        rows.alias("n_rows"),
        percent(F.count_if(F.col(label) == 0), rows).alias("pct_class_0"),
        percent(F.count_if(F.col(label) == 1), rows).alias("pct_class_1"),
    )
    total = F.sum("n_rows").over(Window.partitionBy())  # one row per part
    return per_part.withColumn("pct_rows", percent(F.col("n_rows"), total))
