"""Delimited movement files to typed columns."""

from __future__ import annotations

import csv
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow.sources.files import file_name_fields

# --- fixed values: column -> names it goes by in the public files ------------
RAW_NAMES = {
    "month": ("competênciamov",),
    "region": ("uf",),
    "municipality": ("município",),
    "section": ("seção",),
    "age": ("idade", "faixaetária", "faixaetaria"),
    "schooling": ("graudeinstrução",),
    "occupation": ("cbo2002ocupação",),
    "sex": ("sexo",),
    "salary": ("salário", "valorsaláriofixo"),
    "balance": ("saldomovimentação",),
    "category": ("categoria",),
    "movement_type": ("tipomovimentação",),
    "contract_hours": ("horascontratuais",),
}
# -----------------------------------------------------------------------------

CORRUPT = "_corrupt_record"


def normalise_name(name: str) -> str:
    return name.replace("﻿", "").strip().lower()


def _headers(
    spark: SparkSession, paths: list[str], sep: str, encoding: str
) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header, so each distinct header costs one scan.

    Only the first line of each file is opened, through Hadoop's file system, which
    costs no Spark job. A folder stands for the files in it, each with its own header.
    """
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path in paths:
        for file in _files(spark, path):
            line = _first_line(spark, file, encoding)
            groups[tuple(next(csv.reader([line], delimiter=sep), ()))].append(file)
    return groups


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a folder in name order, or the file itself."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.getFileStatus(target).isDirectory():
        return [path]
    inside = [s.getPath() for s in files.listStatus(target) if s.isFile()]
    return sorted(p.toString() for p in inside if not p.getName().startswith(("_", ".")))


def _first_line(spark: SparkSession, path: str, encoding: str) -> str:
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(conf).open(target)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
        source = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.InputStreamReader(source, encoding)
        return jvm.java.io.BufferedReader(reader).readLine() or ""
    finally:
        stream.close()


def scan_delimited(
    spark: SparkSession,
    paths: str | list[str],
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    """All-string scan with normalised names, `file_name` and a corrupt-record column.

    No value is inferred or cast here. Files whose headers differ are read under
    their own header and matched by name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    scans = []
    for header, members in _headers(spark, paths, sep, encoding).items():
        names = [normalise_name(name) for name in header]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
        scan = (
            spark.read.schema(schema)
            .options(header=True, sep=sep, encoding=encoding, mode="PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(members)
        )
        scans.append(scan.select("*", F.col("_metadata.file_name").alias("file_name")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def conform(raw: DataFrame, names: dict[str, tuple[str, ...]] = RAW_NAMES) -> DataFrame:
    """Rename to the library's columns; the first alias with a value wins.

    A column none of whose aliases exists comes out null. Other columns pass through.
    """
    present = {normalise_name(c): c for c in raw.columns}
    used: set[str] = set()
    columns = []
    for target, aliases in names.items():
        found = [present[a] for a in (*aliases, target) if a in present]
        used.update(found)
        value = F.coalesce(*map(F.col, found)) if found else F.lit(None).cast("string")
        columns.append(value.alias(target))
    return raw.select(*columns, *[c for c in raw.columns if c not in used])


def recognised_paths(spark: SparkSession, paths: list[str], family: str | None) -> list[str]:
    """The paths whose file name is a valid one (of `family`, if given)."""
    named = file_name_fields(
        spark.createDataFrame([(p,) for p in paths], "path string"),
        F.element_at(F.split("path", "/"), -1),
    )
    keep = F.col("recognised") if family is None else F.col("family") == family
    return [r.path for r in named.filter(keep).orderBy("path").collect()]


def read_movement_files(
    spark: SparkSession,
    paths: str | list[str],
    month_from_file: bool = True,
    family: str | None = "MOV",
    sep: str = ";",
    encoding: str = "UTF-8",
    names: dict[str, tuple[str, ...]] = RAW_NAMES,
) -> DataFrame:
    """Raw movement rows (still strings), `month` and `family` taken from the file name.

    Names are checked once per file; a row only cuts the two fields out of its file's
    name at fixed places from the end.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not month_from_file:
        return conform(scan_delimited(spark, paths, sep, encoding), names)
    kept = recognised_paths(spark, paths, family)
    if not kept:
        raise FileNotFoundError(f"no movement files among {len(paths)} paths")
    raw = conform(scan_delimited(spark, kept, sep, encoding), names)
    stem = F.substring_index("file_name", ".", 1)
    return raw.withColumns(
        {"month": F.substring(stem, -6, 6), "family": F.upper(F.substring(stem, -9, 3))}
    )
