"""Order statistics without sorting a whole column in one task.

A global `ORDER BY` window or the built-in exact percentile puts every distinct
value into one task. Here values are first counted
(with map-side combine, so a value holding a third of the rows is one row per task), then
written in order, one range of values a file; running totals are taken inside each file in
parallel and shifted by the totals of the files before it. No list of edges is searched, so
the work for a value does not grow with the number of files. Results are exact wherever the
ranges are cut.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.sources.layers import materialise


def value_counts(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Rows (by..., metric, value, n) for the non-null values of several columns."""
    ids = [F.col(c) for c in by] + ([F.col(weight)] if weight else [])
    long = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        ids, list(columns), "metric", "value"
    )
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        long.filter(F.col("value").isNotNull()).groupBy(*by, "metric", "value").agg(n.alias("n"))
    )


def ordered_files(df: DataFrame, order: Sequence[str], name: str, files: int | None = None) -> DataFrame:
    """`df` sorted by `order`, one range a file, with `_file` (its place among the files); written once.

    Spark's range exchange samples the rows for its bounds; neither they nor anything else
    that grows with the data reaches a plan or the driver. A file holds the rows of a task,
    and the number of rows in it follows from the partitions the session asks for.
    """
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    rows = ranged.sortWithinPartitions(*order)
    # Spark numbers rows by task: the task's place is in the upper bits
    return materialise(rows.withColumn("_file", F.shiftright(F.monotonically_increasing_id(), 33)), name)


def running_totals(
    counts: DataFrame,
    by: Sequence[str],
    value: str,
    totals: Sequence[str],
    values_per_slot: int | None = None,
) -> DataFrame:
    """Add `<c>_before` and `<c>_all` for every total column `c`.

    `counts` has one row per (`by`, `value`); it may have any number of groups. `<c>_before`
    sums `c` over smaller values of the same group, `<c>_all` over the whole group. The
    rows lie in ordered files; a group's totals per file, at most a row for each, are summed
    up to where a file starts, and inside a file a window adds the rest. `values_per_slot`
    sets how many rows a file holds; else the session's partitions do.
    """
    by = list(by)
    groups = [f"_by_{c}" for c in by]
    counts = materialise(counts, "counts")
    files = max(1, math.ceil(counts.count() / values_per_slot)) if values_per_slot else None
    placed = ordered_files(counts, [*by, value], "ordered-counts", files)
    per_file = placed.groupBy(*by, "_file").agg(*[F.sum(c).alias(f"_{c}") for c in totals])
    group = Window.partitionBy(*by)
    before = group.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select(
        *[F.col(c).alias(g) for c, g in zip(by, groups)],
        F.col("_file").alias("_at"),
        *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}_off") for c in totals],
        *[F.sum(f"_{c}").over(group).alias(f"{c}_all") for c in totals],
    )
    inside = Window.partitionBy(*by, "_file").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    here = placed["_file"] == offsets["_at"]
    for c, g in zip(by, groups):
        here = here & placed[c].eqNullSafe(offsets[g])
    result = placed.join(offsets, here)
    for c in totals:
        running = F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_{c}_off")
        result = result.withColumn(f"{c}_before", running)
    return result.drop("_file", "_at", *groups, *[f"_{c}_off" for c in totals])


def _rank_of(probability: float, total: Column) -> Column:
    """ceil(probability * total), at least 1, with the probability as an exact decimal."""
    share = Decimal(str(probability)).normalize()
    digits = max(0, -share.as_tuple().exponent)
    scaled = F.lit(int(share.scaleb(digits))).cast("decimal(18,0)") * total.cast("decimal(19,0)")
    whole = F.lit(10**digits).cast("decimal(19,0)")
    return F.greatest(F.call_function("div", scaled + whole - 1, whole), F.lit(1).cast("bigint"))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    quantiles: dict[str, float],
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """One row per (by..., metric) with one column per named quantile.

    Discrete quantiles: the smallest value whose cumulative share reaches p, so
    always a value that occurs.
    """
    counts = value_counts(df, columns, by, weight)
    ranked = running_totals(counts, [*by, "metric"], "value", ["n"])
    reached = F.col("n_before") + F.col("n")
    return ranked.groupBy(*by, "metric").agg(
        *[
            F.min(F.when(reached >= _rank_of(p, F.col("n_all")), F.col("value"))).alias(name)
            for name, p in quantiles.items()
        ]
    )


def approximate_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    quantiles: dict[str, float],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """Same shape from a mergeable sketch: one pass, bounded state, error 1/accuracy."""
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [F.col(c) for c in by], list(columns), "metric", "value"
    )
    sketch = F.percentile_approx("value", list(quantiles.values()), accuracy)
    found = long.groupBy(*by, "metric").agg(sketch.alias("_q"))
    return found.select(
        *by, "metric", *[F.col("_q")[i].alias(name) for i, name in enumerate(quantiles)]
    )
