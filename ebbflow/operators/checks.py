"""Writes that prove themselves: what was written against what can be read back.

Expectations are gathered by an observation while the rows are written, so the computation
is not run a second time; the same figures are then taken from the stored table. A lost,
doubled, cut or changed row stops the run, and every check stays in a report.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ebbflow.operators.quality import ExpectationError
from ebbflow.sources import sinks

REPORT = (
    "layer string, rows_expected bigint, rows_written bigint, rows_read bigint, n_label_1_written bigint, "
    "n_label_1_read bigint, same_content boolean, ok boolean"
)
UNREADABLE = (PySparkException, Py4JJavaError)  # the reader of footers raises the latter
Writer = Callable[[DataFrame, str], None]


def _figures(columns: Sequence[str], label: str | None) -> list[Column]:
    """Rows, rows of class 1 and a checksum that no order and no layout of files changes.

    Values count as text, as a partition value comes back with a type of its own.
    """
    row = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(columns)])
    ones = F.count_if(F.col(label) == 1) if label else F.lit(None).cast("bigint")
    return [
        F.count(F.lit(1)).alias("rows"),
        (ones if label else F.max(ones)).alias("ones"),
        F.sum(row.cast("decimal(38,0)")).alias("content"),
    ]


def write_checked(
    df: DataFrame,
    base: str,
    layer: str,
    write: Writer = sinks.write_table,
    label: str | None = None,
    exactly: int | None = None,
) -> DataFrame:
    """Write `df`, read it back, and return the stored table and its check as one row.

    `exactly` pins the number of rows. Raises `ExpectationError` when the two sides differ,
    when the pinned number is missed, or when a file can't be read.
    """
    spark, seen = df.sparkSession, Observation()
    plain = [c for c, kind in df.dtypes if not kind.startswith(("array", "map", "struct", "binary"))]
    figures = _figures(plain, label)
    write(df.observe(seen, *figures), base)
    wrote = seen.get
    try:
        read = sinks.read_table(spark, base).agg(*figures).first().asDict()
    except UNREADABLE as cause:
        raise ExpectationError(f"{layer}: the written table can't be read") from cause
    same = read["content"] == wrote["content"]
    ok = same and read["rows"] == wrote["rows"] and read["ones"] == wrote["ones"] and exactly in (None, read["rows"])
    row = (layer, exactly, wrote["rows"], read["rows"], wrote["ones"], read["ones"], same, ok)
    report = spark.createDataFrame([row], REPORT)
    if not ok:
        raise ExpectationError(f"{layer}: {report.first().asDict()}")
    return report


def verify(spark: SparkSession, base: str, layer: str, report: DataFrame) -> None:
    """Check a stored table again, later, against the rows that its report says were written."""
    expected = report.filter(F.col("layer") == layer).select("rows_written").first()  # one row a layer
    if expected is None:
        raise ExpectationError(f"{layer}: no check is stored")
    try:
        stored = sinks.read_table(spark, base)
        # every column is counted, so every part of every file is read
        n = stored.agg(F.count(F.lit(1)), *[F.count(F.col(f"`{c}`")) for c in stored.columns]).first()[0]
    except UNREADABLE as cause:
        raise ExpectationError(f"{layer}: the stored table can't be read") from cause
    if n != expected[0]:
        raise ExpectationError(f"{layer}: {n} rows are left of {expected[0]}")


def record(report: DataFrame, base: str) -> None:
    """Add a check to the report table below `base`."""
    report.write.mode("append").parquet(base)
