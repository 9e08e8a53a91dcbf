"""File listing, file-name fields and the ingest manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbflow.settings import FILE_FAMILIES

FIRST_YEAR, LAST_YEAR = 2000, 2100


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Files below `folder` as rows; contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(folder)
    )
    return listing.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "length",
        "modificationTime",
    )


# a delivery is a text file or the archive it came in; copies such as `.bak` are neither
EXTENSIONS = ("txt", "csv", "7z")
TEXT_EXTENSIONS = ("txt", "csv")


def file_name_pattern(prefix: str = "[A-Z]*", extensions: Sequence[str] = EXTENSIONS) -> str:
    """`<prefix><family><YYYY><MM>.<extension>`, also compressed, any letter case; nothing else."""
    return rf"(?i)^{prefix}({'|'.join(FILE_FAMILIES)})(\d{{4}})(\d{{2}})\.({'|'.join(extensions)})(\.(gz|bz2|zst))?$"


def file_name_fields(
    df: DataFrame,
    name: Column | str = "file_name",
    prefix: str = "[A-Z]*",
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR),
    extensions: Sequence[str] = EXTENSIONS,
) -> DataFrame:
    """Add `family`, `year`, `month_no`, `month` and `recognised` from a file name."""
    column = F.col(name) if isinstance(name, str) else name
    pattern = file_name_pattern(prefix, extensions)
    fields = (
        df.withColumn("_family", F.upper(F.regexp_extract(column, pattern, 1)))
        .withColumn("_year", F.regexp_extract(column, pattern, 2).try_cast("int"))
        .withColumn("_month", F.regexp_extract(column, pattern, 3).try_cast("int"))
    )
    recognised = F.coalesce(
        (F.col("_family") != "") & F.col("_year").between(*years) & F.col("_month").between(1, 12),
        F.lit(False),
    )
    return (
        fields.withColumn("recognised", recognised)
        .withColumn("family", F.when(F.col("recognised"), F.col("_family")))
        .withColumn("year", F.when(F.col("recognised"), F.col("_year")))
        .withColumn("month_no", F.when(F.col("recognised"), F.col("_month")))
        .withColumn(
            "month",
            F.when(
                F.col("recognised"), (F.col("_year") * 100 + F.col("_month")).cast("string")
            ),
        )
        .drop("_family", "_year", "_month")
    )


def ingest_manifest(
    files: DataFrame,
    ingested: DataFrame,
    month: str | None = None,
    family: str | None = None,
    prefix: str = "[A-Z]*",
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR),
) -> DataFrame:
    """One row per file with a `status`.

    `unrecognised` (bad name), `filtered` (not the month or family asked for),
    `ingested` (its name is in `ingested`), `duplicate` (not the first name of its family and
    month) or `new`.
    """
    named = file_name_fields(files, prefix=prefix, years=years)
    done = ingested.select("file_name").distinct().withColumn("_done", F.lit(True))
    wanted = F.lit(True)
    if month:
        wanted = wanted & (F.col("month") == month)
    if family:
        wanted = wanted & (F.col("family") == family.upper())
    status = (
        F.when(~F.col("recognised"), "unrecognised")
        .when(~wanted, "filtered")
        .when(F.col("_done"), "ingested")
        .when(F.col("_place") > 1, "duplicate")
        .otherwise("new")
    )
    # a window holds the files of one family and month
    same_month = Window.partitionBy("recognised", "family", "month", F.when(~F.col("recognised"), F.col("file_name")))
    place = F.row_number().over(same_month.orderBy(F.col("_done").desc_nulls_last(), "file_name"))
    known = named.join(done, "file_name", "left").withColumn("_place", place)
    return known.withColumn("status", status).drop("_done", "_place")


def manifest_summary(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))
