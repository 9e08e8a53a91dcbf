"""Places in a global order, by range-partitioned files with counts.

Spark's range exchange deals the rows, each task sorts its range and writes it with the
row's place in it. Counts per file and group, of which there are at most files plus groups,
give each file its start. No edge reaches the driver or a plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.store import stored

IN_FILE = (1 << 33) - 1  # a row's place in its task, in the lower bits of Spark's row numbers


def placed(df: DataFrame, by: str, order: Sequence[Column], name: str) -> DataFrame:
    """`df` with `rank` (0-based, by `order` inside a value of `by`) and `n` (rows of that value).

    `by` is never null. `order` tells rows apart, save those alike in every respect. A value of
    `by` with a third of all rows lies in many files; a window over it has a row for each.
    """
    whole = [F.col(by), *order]
    rows = df.repartitionByRange(*whole).sortWithinPartitions(*whole)
    number = F.monotonically_increasing_id()
    rows = stored(rows.withColumn("_number", number), name)
    rows = rows.withColumns({"_file": F.shiftright("_number", 33), "_at": F.col("_number").bitwiseAND(IN_FILE)}).drop("_number")
    per_file = rows.groupBy(by, "_file").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(by).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_file.select(
        by,
        "_file",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_start"),
        F.sum("_rows").over(Window.partitionBy(by)).alias("n"),
    )
    return rows.join(starts, [by, "_file"]).withColumn("rank", F.col("_start") + F.col("_at")).drop("_file", "_at", "_start")
