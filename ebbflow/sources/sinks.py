"""Parquet tables, reports and the checks that follow a write."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ebbflow.functions import is_blank


def write_months(
    df: DataFrame,
    base: str,
    month: str = "month",
    rebalance: bool = False,
    months: Sequence[str] = (),
) -> None:
    """Replace the months present in `df` and those named in `months`; leave the others alone.

    A named month without a row loses the rows it had: name every month that was delivered.
    Its rows are counted while they are written, so nothing is read twice.

    A movement file holds one month, so a task holds one or two and writes as many
    files: no shuffle is needed. For rows in any other order ask for `rebalance`, which
    brings each month's rows together and splits a large month over several tasks.
    """
    rows = df.withColumn("competencia", F.col(month))
    if rebalance:
        rows = rows.hint("rebalance", F.col("competencia"))
    seen = Observation()
    if months:
        counts = [F.count_if(F.col("competencia") == m).alias(m) for m in months]
        rows = rows.observe(seen, *counts)
    (
        rows.write.partitionBy("competencia")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(base)
    )
    if months:
        for m, n in seen.get.items():
            if n == 0:
                remove_folder(df.sparkSession, f"{base}/competencia={m}")


def write_partitioned(df: DataFrame, base: str, by: str) -> None:
    """Overwrite a table partitioned by `by`, in files of an even size.

    The rebalance hint lets adaptive execution split a large partition value over
    several tasks and merge small ones.
    """
    df.hint("rebalance", F.col(by)).write.partitionBy(by).mode("overwrite").parquet(base)


def write_table(df: DataFrame, base: str) -> None:
    df.write.mode("overwrite").parquet(base)


def read_table(spark: SparkSession, base: str) -> DataFrame:
    """Always the base folder, so partition columns are discovered and pruned."""
    return spark.read.parquet(base)


def write_report(df: DataFrame, base: str, kind: str = "json") -> None:
    """A report of bounded size (a summary or a metrics table), as one file.

    Only the finished rows meet in one task; `coalesce` would pull the last stage of
    the computation in there as well.
    """
    writer = df.repartition(1).write.mode("overwrite")
    writer.option("header", True).csv(base) if kind == "csv" else writer.json(base)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a partition's folder; one that doesn't exist is no error."""
    target, files = _file_system(spark, path)
    files.delete(target, True)


def _exists(spark: SparkSession, path: str) -> bool:
    target, files = _file_system(spark, path)
    return files.exists(target)


def table_exists(spark: SparkSession, base: str) -> bool:
    return _exists(spark, base)


def readback_report(
    expected: DataFrame, base: str, partition: str | None = None, label: str | None = None
) -> DataFrame:
    """Compare a written table with what should be in it: one row.

    Each side is read once. Columns: rows before and after, equal or not, success
    marker, partitions and files seen, blank cells, rows of label 1.
    """
    spark = expected.sparkSession
    stored = spark.read.parquet(base).withColumn("_file", F.col("_metadata.file_path"))
    types = dict(stored.dtypes)
    blanks = reduce(
        lambda a, b: a + b,
        [
            F.count_if(is_blank(F.col(c), types[c]))
            for c in stored.columns
            if c != "_file"
        ],
    )
    none: Column = F.lit(None).cast("bigint")
    # a file lies in one partition, so the counts per file hold the partitions, too
    per_file = stored.groupBy("_file", (F.col(partition) if partition else none).alias("_part")).agg(
        F.count(F.lit(1)).alias("n"),
        blanks.alias("blanks"),
        (F.count_if(F.col(label) == 1) if label else none).alias("ones"),
    )
    nothing = F.lit(0).cast("bigint")
    after = per_file.agg(
        F.coalesce(F.sum("n"), nothing).alias("rows_after"),
        F.countDistinct("_file").alias("n_files"),
        (F.countDistinct("_part") if partition else none).alias("n_partitions"),
        F.coalesce(F.sum("blanks"), nothing).alias("n_blank_cells"),
        (F.coalesce(F.sum("ones"), nothing) if label else none).alias("n_label_1"),
    )
    before = expected.agg(F.count(F.lit(1)).alias("rows_before"))
    marker = F.lit(_exists(spark, f"{base}/_SUCCESS")).alias("success_marker")
    report = after.select(before.scalar().alias("rows_before"), "*", marker)
    return report.withColumn("rows_match", F.col("rows_before") == F.col("rows_after"))


def upsert_metrics(
    stored: DataFrame, new: DataFrame, key: str = "model", version: str = "run"
) -> DataFrame:
    """Metrics rows with the latest `version` of every `key`.

    Repeating a run replaces its row; rows of other models stay.
    """
    latest = Window.partitionBy(key).orderBy(F.col(version).desc())
    both = stored.unionByName(new)
    return both.withColumn("_rn", F.row_number().over(latest)).filter("_rn = 1").drop("_rn")


def store_metrics(new: DataFrame, base: str, key: str = "model") -> DataFrame:
    """Append `new` as the next run below `base` and return the latest row per `key`.

    Runs are folders of their own, so nothing is rewritten in place and a failed write
    costs no earlier row.
    """
    spark = new.sparkSession
    run = 1
    if _exists(spark, base):
        run += spark.read.parquet(base).agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]
    new.write.mode("overwrite").parquet(f"{base}/run={run}")
    stored = spark.read.parquet(base)
    return upsert_metrics(stored.filter(F.col("run") < run), stored.filter(F.col("run") == run), key)
