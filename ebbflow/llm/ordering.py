"""Global order without a global sort in one task.

Rows are cut into ranges of an integer key by split values read from the data (eight bytes
for every `rows_per_range` rows). Totals per range are few; their running sum gives each
range its start, and inside a range a window adds the rest. Nothing but the ranges' totals
meets in one place.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 20_000
COARSE = 1_000


def split_values(df: DataFrame, key: str, rows_per_range: int = ROWS_PER_RANGE) -> list[int]:
    """Sorted distinct values of `key` that start a new range; empty for a small table.

    Up to COARSE ranges come from one quantile sketch; beyond that each coarse range gets
    a sketch of its own, in parallel.
    """
    ranges = math.ceil(df.count() / rows_per_range)
    if ranges < 2:
        return []
    n = min(ranges, COARSE)
    cuts = [i / n for i in range(1, n)]
    found = df.agg(F.percentile_approx(key, cuts, 20 * COARSE)).first()[0] or []
    edges = sorted(set(found))
    if ranges > COARSE:
        m = math.ceil(ranges / COARSE)
        fine = [i / m for i in range(1, m)]
        per_range = df.groupBy(range_of(F.col(key), edges).alias("_r")).agg(
            F.percentile_approx(key, fine, 20 * COARSE).alias("_cuts")
        )
        more = (value for row in per_range.collect() for value in row["_cuts"] or [])
        edges = sorted({*edges, *more})
    return edges


def range_of(key: Column, edges: Sequence[int]) -> Column:
    """Number of the range that holds `key`: how many edges are not above it (null: 0).

    A two-level search keeps the cost per row near the square root of the number of edges.
    """
    if not edges:
        return F.lit(0)
    width = math.isqrt(len(edges)) + 1
    blocks = [edges[i : i + width] for i in range(0, len(edges), width)]
    heads = F.expr(_longs([b[0] for b in blocks]))
    inner = F.expr(f"array({','.join(_longs(b) for b in blocks)})")
    block = F.size(F.filter(heads, lambda e: e <= key))
    inside = F.size(F.filter(F.get(inner, block - 1), lambda e: e <= key))
    found = F.when(block > 0, (block - 1) * width + inside).otherwise(0)
    return F.coalesce(F.when(key.isNotNull(), found), F.lit(0)).cast("int")


def _longs(values: Sequence[int]) -> str:
    return f"array({','.join(f'bigint({v})' for v in values)})"


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add `<v>_before`: the sum of `v` over earlier rows of the same group.

    `order` starts with the integer key that cuts the ranges and must tell rows apart, save
    for rows that are alike in every respect; nulls come first. `by` columns are never null. `df` is read three
    times, so it is a stored table of narrow rows. A group holding a third of all rows is
    spread over as many windows as any other rows.
    """
    edges = split_values(df, order[0], rows_per_range)
    placed = df.withColumn("_range", range_of(F.col(order[0]), edges))
    keys = [*by, "_range"]
    totals = placed.groupBy(*keys).agg(*[F.sum(v).alias(f"_{v}_sum") for v in values])
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"_{v}_sum").over(earlier), F.lit(0)).alias(f"_{v}_base") for v in values],
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.join(starts, keys)
    for v in values:
        before = F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"_{v}_base")
        summed = summed.withColumn(f"{v}_before", before)
    return summed.drop("_range", *[f"_{v}_base" for v in values])
