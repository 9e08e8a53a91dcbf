"""Files that arrived since the last run, through Structured Streaming.

The stream's checkpoint remembers which files were seen, so there is no month
loop and no bookkeeping. A micro-batch only says which months changed; those
months are rebuilt from all their files and replaced. A replayed batch therefore
writes the same result, and a correction file that arrives months later extends
its month instead of replacing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ebbflow.operators.cleaning import in_regions, typed, valid_movements
from ebbflow.sources.delimited import read_movement_files
from ebbflow.sources.files import file_name_fields, list_files
from ebbflow.sources.sinks import write_months


def month_stream(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Names of newly arrived files with their fields; file contents are not read."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(spark.read.format("binaryFile").load(folder).schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )
    return file_name_fields(files).filter("recognised")


def ingest_new_files(
    spark: SparkSession,
    folder: str,
    base: str,
    checkpoint: str,
    family: str = "MOV",
    region_codes: tuple[int, ...] | None = None,
    thousands_sep: str | None = None,
    glob: str = "*",
) -> StreamingQuery:
    """Start one available-now run from `folder` into the month-partitioned `base`."""

    def replace_months(batch: DataFrame, _: int) -> None:
        # at most one row per calendar month
        changed = [r.month for r in batch.select("month").distinct().collect()]
        if not changed:
            return
        files = file_name_fields(list_files(batch.sparkSession, folder, glob)).filter(
            (F.col("family") == family) & F.col("month").isin(*changed)
        )
        paths = [r.path for r in files.select("path").collect()]
        raw = read_movement_files(batch.sparkSession, paths, family=family)
        rows = valid_movements(in_regions(typed(raw, thousands_sep), region_codes))
        write_months(rows, base, months=changed)

    arrivals = month_stream(spark, folder, glob).filter(F.col("family") == family)
    return (
        arrivals.writeStream.foreachBatch(replace_months)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
