"""Late filings and exclusions merged into the months that they belong to.

A month's first delivery is followed by others: movements declared too late, which belong
to the month in which they happened, and exclusions, which repeat a movement that is to be
taken back. The data have no record number, so an exclusion cancels one row that has its
values in all the columns compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.sources import sinks

# what identifies a movement; the salary's text may be corrected in an exclusion
KEY = ("month", "region", "section", "age", "schooling", "occupation", "sex", "salary", "balance", "category")


def merged(movements: DataFrame, late: DataFrame, excluded: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Movements and late filings less the exclusions, the columns of `key`.

    A difference of multisets: of rows with equal values as many go as there are
    exclusions, and no more than there are rows. Nulls are equal to each other. Rows are
    counted before they are shuffled, so a key that many rows share is one row a task.
    """
    both = movements.select(*key).unionByName(late.select(*key))
    return both.exceptAll(excluded.select(*key))


def unmatched(movements: DataFrame, late: DataFrame, excluded: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Exclusions that take nothing back, the columns of `key`."""
    both = movements.select(*key).unionByName(late.select(*key))
    return excluded.select(*key).exceptAll(both)


def merge_into_months(
    spark: SparkSession, base: str, late: DataFrame, excluded: DataFrame, target: str, key: Sequence[str] = KEY
) -> list[str]:
    """Rewrite, once each, the months of the table `base` that filings or exclusions touch, into `target`.

    `target` is another table, as a month is read while it is rewritten; months that
    nothing touches are copied with the first call and then left alone. Returns the months.
    """
    touched = late.select("month").unionByName(excluded.select("month")).distinct()
    # at most one row per calendar month
    months = sorted(r.month for r in touched.filter("month is not null").collect())
    stored = sinks.read_table(spark, base)
    if not sinks.table_exists(spark, target):
        rest = stored.filter(~F.col("competencia").isin(*months)).select(*key)
        sinks.write_months(rest, target, rebalance=True)
    if months:
        old = stored.filter(F.col("competencia").isin(*months))
        sinks.write_months(merged(old, late, excluded, key), target, rebalance=True, months=months)
    return months
