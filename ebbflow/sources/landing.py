"""A folder of monthly deliveries, read in one plan: good rows and quarantined lines side by side.

The driver sees neither paths nor headers. A first scan finds each file's first line; the
table of headers, a row for each file, says at which place a file holds each column. A
second scan reads every line once and cuts it by its own file's places. Lines that are no
record, or no valid movement, stay beside the good rows with their file and a reason, so one
pass and one write hold both. Files that can't be read get a status in the manifest.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ebbflow.operators.cleaning import rejection_reason, typed
from ebbflow.sources.delimited import RAW_NAMES
from ebbflow.sources.files import FIRST_YEAR, LAST_YEAR, file_name_fields, ingest_manifest
from ebbflow.sources.layers import materialise
from ebbflow.sources.sinks import remove_folder

NEEDED = ("region", "section", "balance")  # a header without one of these is of another kind


@dataclass(frozen=True)
class Delivery:
    """How a folder's files are named and cut."""

    family: str | None = "MOV"
    prefix: str = "[A-Z]*"
    glob: str = "*"
    sep: str = ";"
    encoding: str = "UTF-8"
    thousands_sep: str | None = None
    years: tuple[int, int] = (FIRST_YEAR, LAST_YEAR)
    month_from_name: bool = True  # else the month column of the rows counts


def delivery_name(path: Column) -> Column:
    """The name a file was delivered under; for a part of a written folder, the folder's."""
    parts = F.split(path, "/")
    own = F.element_at(parts, -1)
    folder = F.regexp_extract(F.element_at(parts, -2), "([^=]*)$", 1)
    return F.when(own.startswith("part-"), folder).otherwise(own)


def _options(spec: Delivery) -> dict[str, str]:
    return {"recursiveFileLookup": "true", "pathGlobFilter": spec.glob}


def listed(spark: SparkSession, folder: str, spec: Delivery = Delivery()) -> DataFrame:
    """(file, file_name, length): every file of the folder; contents are not read.

    Spark's scans pass over files of no bytes, so these are not listed.
    """
    found = spark.read.format("binaryFile").options(**_options(spec)).load(folder)
    path = F.col("_metadata.file_path")
    return found.select(path.alias("file"), delivery_name(path).alias("file_name"), "length")


def lines(spark: SparkSession, folder: str, spec: Delivery = Delivery()) -> DataFrame:
    """(file, at_start, line): every line of every file, decoded and otherwise as it stands.

    What can be read of a damaged file is read; `damaged` tells which files those are.
    """
    # no separator and no quotes: the whole line is one column
    whole = {"sep": "\u0001", "quote": "", "encoding": spec.encoding, "ignoreCorruptFiles": "true", **_options(spec)}
    scan = spark.read.schema("line string").options(**whole).csv(folder)
    start = F.col("_metadata.file_block_start") == 0
    return scan.select(F.col("_metadata.file_path").alias("file"), start.alias("at_start"), "line").filter("line is not null")


def damaged(spark: SparkSession, folder: str, spec: Delivery = Delivery()) -> DataFrame:
    """(file, problem) of gzip files that end early or hold something else.

    Each is inflated by a task of its own as it is read: its bytes come as they stand, cut at
    line feeds, so no task holds a file. Only compressed files are opened.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_file: tuple[str, int, Inflation] | None = None

        def closed() -> Iterator[pa.RecordBatch]:
            if open_file is None:
                return
            file, length, found = open_file
            if length - found.seen == 1:  # the line feed that ends the file
                found.add(b"\n")
            # the reader of lines passes over a mark of byte order, which begins no gzip member
            problem = found.problem() if found.seen == length else "unreadable"
            if problem:
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([problem])], names=["file", "problem"])

        for batch in batches:
            files, at = pc.run_end_encode(batch.column(0)), 0
            for file, end in zip(files.values.to_pylist(), files.run_ends.to_pylist()):
                if open_file is None or open_file[0] != file:
                    yield from closed()
                    open_file = (file, batch.column(1)[at].as_py(), Inflation())
                else:
                    open_file[2].add(b"\n")
                open_file[2].add(b"\n".join(batch.column(2).slice(at, end - at).to_pylist()))
                at = end
        yield from closed()

    as_it_stands = {"io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec", "lineSep": "\n"}
    for name in ("io.compress.passthrough.extension", "org.apache.hadoop.shaded.io.compress.passthrough.extension"):
        as_it_stands[name] = ".gz"  # the second is its name in the library that Spark brings along
    packed = spark.read.options(**as_it_stands, **_options(spec)).text(folder).filter(F.col("_metadata.file_path").endswith(".gz"))
    pieces = packed.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size"), F.col("value").cast("binary"))
    return pieces.mapInArrow(check, "file string, problem string")


class Inflation:
    """Gzip members that come in pieces, inflated a step at a time; nothing of them is kept."""

    def __init__(self, step: int = 1 << 20) -> None:
        self.seen, self._step, self._held = 0, step, bytearray()
        self._member, self._failed = zlib.decompressobj(31), False

    def add(self, piece: bytes | memoryview) -> None:
        self.seen += len(piece)
        if self._failed:
            return
        self._held += piece
        while len(self._held) >= self._step:
            self._inflate(bytes(self._held[: self._step]))
            del self._held[: self._step]

    def problem(self) -> str | None:
        """Why the members given can't be inflated to their end; None if they can."""
        if not self.seen:
            return "empty"
        self._inflate(bytes(self._held))
        self._held.clear()
        if self._failed:
            return "unreadable"
        return None if self._member.eof else "truncated"

    def _inflate(self, rest: bytes) -> None:
        try:
            while rest and not self._failed:
                if self._member.eof:
                    if not rest.strip(b"\0"):
                        break
                    self._member = zlib.decompressobj(31)
                piece = rest
                while piece:  # output is bounded, whatever a byte inflates to
                    self._member.decompress(piece, 4 * self._step)
                    piece = self._member.unconsumed_tail
                rest = self._member.unused_data
        except zlib.error:
            self._failed = True


def inflation_problem(data: memoryview, step: int = 1 << 20) -> str | None:
    """Why gzip members can't be inflated to their end; None if they can."""
    found = Inflation(step)
    for at in range(0, len(data), step):
        found.add(data[at : at + step])
    return found.problem()


def headers(scanned: DataFrame, names: Mapping[str, tuple[str, ...]] = RAW_NAMES, sep: str = ";") -> DataFrame:
    """(file, header, n_fields, p_<column>): where each file holds each column, one row per file.

    `p_<column>` lists the places (from 0) of the names a column goes by, in their order;
    it is empty if the file has none of them.
    """
    first = scanned.filter("at_start").withColumn("_n", F.monotonically_increasing_id())
    # a set in the buffer makes this an aggregate by hash; with text alone every line would be sorted by its file
    first = first.groupBy("file").agg(F.min_by("line", "_n").alias("header"), F.collect_set("at_start").alias("_at_start"))
    first = first.select("file", F.when(F.get("_at_start", F.lit(0)), F.col("header")).alias("header"))
    cut = F.split(F.regexp_replace("header", "[\"﻿]", ""), re.escape(sep))
    first = first.withColumn("_names", F.transform(cut, lambda n: F.lower(F.trim(n))))

    def places(target: str, aliases: tuple[str, ...]) -> Column:
        found = F.array(*[F.array_position("_names", n).cast("int") - 1 for n in (*aliases, target)])
        return F.filter(found, lambda p: p >= 0)

    columns = [places(t, a).alias(f"p_{t}") for t, a in names.items()]
    return first.select("file", "header", F.size("_names").alias("n_fields"), *columns)


def cut_lines(
    scanned: DataFrame, known: DataFrame, width: int, names: Mapping[str, tuple[str, ...]] = RAW_NAMES, sep: str = ";"
) -> DataFrame:
    """The library's columns (text), `line`, `malformed` and what else `known` holds; headers are left out.

    `malformed` is `quote` for a line with a quote that isn't closed and `fields` for one
    with more or fewer fields than its header. The first alias with a value wins.
    """
    rows = scanned.join(known, "file").filter("line <> header")
    schema = ", ".join(f"c{i} string" for i in range(width))
    rows = rows.withColumn("_cut", F.from_csv("line", schema, {"sep": sep, "mode": "PERMISSIVE"}))
    rows = rows.withColumn("_fields", F.array(*[F.col(f"_cut.c{i}") for i in range(width)]))
    bare = F.regexp_replace("line", '"([^"]|"")*"', "")
    fields = F.size(F.split(bare, re.escape(sep)))
    malformed = F.when(bare.contains('"'), "quote").when(fields != F.col("n_fields"), "fields")

    def value(target: str) -> Column:
        found = F.transform(f"p_{target}", lambda p: F.get("_fields", p))
        return F.get(F.filter(found, lambda v: v.isNotNull()), 0)

    carried = [c for c in known.columns if c not in ("header", "n_fields") and not c.startswith("p_")]
    return rows.select(*carried, *[value(t).alias(t) for t in names], "line", malformed.alias("malformed"))


def manifest(
    spark: SparkSession, folder: str, ingested: DataFrame | None = None, spec: Delivery = Delivery()
) -> tuple[DataFrame, DataFrame]:
    """(deliveries, files): a status for each delivered name, and the headers of the files to read.

    To the statuses of `ingest_manifest` comes `error`, with a `problem`: the delivery is
    `empty`, `unreadable`, `truncated`, or its `header` lacks a needed column. Both tables
    are written once; they have a row for each delivery and file.
    """
    files = listed(spark, folder, spec)
    known = headers(lines(spark, folder, spec), sep=spec.sep)
    bad = damaged(spark, folder, spec)
    missing = F.least(*[F.size(f"p_{c}") for c in NEEDED]) == 0
    files = files.join(known, "file", "left").join(bad, "file", "left")
    problem = F.coalesce("problem", F.when(F.col("header").isNull(), "empty").when(missing, "header"))
    files = materialise(files.withColumn("problem", problem), "delivered-files")
    per_name = files.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"), F.min("problem").alias("problem")
    )
    if ingested is None:
        ingested = spark.createDataFrame([], "file_name string")
    # a damaged delivery must not shadow a sound copy of its month
    sound = ingest_manifest(per_name.filter("problem is null"), ingested, family=spec.family, prefix=spec.prefix, years=spec.years)
    failed = ingest_manifest(per_name.filter("problem is not null"), ingested, family=spec.family, prefix=spec.prefix, years=spec.years)
    wrong = F.when(F.col("status").isin("new", "duplicate"), "error").otherwise(F.col("status"))
    both = sound.unionByName(failed.withColumn("status", wrong))
    return materialise(both, "deliveries"), files


def landed_rows(
    spark: SparkSession,
    folder: str,
    deliveries: DataFrame,
    files: DataFrame,
    spec: Delivery = Delivery(),
    region_codes: tuple[int, ...] | None = None,
) -> DataFrame:
    """Every line of the new deliveries as a row: typed columns, `family`, `file_name`, `reason`, `line`.

    `reason` is null for a valid movement, and then `line` is, too. Rows of regions not
    asked for are left out; lines without a readable region are kept with their reason.
    """
    new = deliveries.filter("status = 'new'").select("file_name", F.col("month").alias("of_month"), "family")
    # written, so that Spark sees how small it is and lines needn't move to their file's places
    known = materialise(files.join(new, "file_name").drop("length", "problem"), "known-files")
    width = files.agg(F.max("n_fields")).first()[0] or 1
    cut = cut_lines(lines(spark, folder, spec), known, width, sep=spec.sep)
    if spec.month_from_name:
        cut = cut.withColumn("month", F.col("of_month"))
    rows = typed(cut, spec.thousands_sep, ("family", "file_name", "malformed", "line", "of_month"))
    # the columns of a malformed line can't be trusted
    why = F.coalesce("malformed", rejection_reason(F.col("month_seq")))
    rows = rows.withColumn("reason", why).drop("malformed")
    if region_codes is not None:
        rows = rows.filter(F.col("reason").isNotNull() | F.col("region").isin(*region_codes))
    return rows.withColumn("line", F.when(F.col("reason").isNotNull(), F.col("line")))


def land(
    spark: SparkSession,
    folder: str,
    base: str,
    ingested: DataFrame | None = None,
    spec: Delivery = Delivery(),
    region_codes: tuple[int, ...] | None = None,
) -> DataFrame:
    """Write good rows and quarantined lines of the new deliveries below `base`; returns the deliveries.

    The table is cut by `quarantined` and by the delivered month, and the months written
    are replaced. `movements` and `quarantine` read its two sides, each by its partitions.
    """
    deliveries, files = manifest(spark, folder, ingested, spec)
    rows = landed_rows(spark, folder, deliveries, files, spec, region_codes)
    rows = rows.withColumns({"quarantined": F.col("reason").isNotNull(), "competencia": F.col("of_month")}).drop("of_month")
    seen = Observation()
    side = F.concat_ws("/", F.col("quarantined").cast("string"), "competencia")
    rows = rows.observe(seen, F.collect_set(side).alias("sides"))  # two a month at most
    writer = rows.write.partitionBy("quarantined", "competencia").option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(base)
    # what an earlier landing of a month held on a side that is empty now
    months = [r.month for r in deliveries.filter("status = 'new'").select("month").distinct().collect()]
    for quarantined in ("true", "false"):
        for month in months:
            if f"{quarantined}/{month}" not in seen.get["sides"]:
                remove_folder(spark, f"{base}/quarantined={quarantined}/competencia={month}")
    return deliveries


def movements(spark: SparkSession, base: str, months: Sequence[str] | None = None) -> DataFrame:
    """The valid movements of a landed table, of all months or of those delivered for `months`."""
    rows = spark.read.parquet(base).filter(F.col("quarantined").cast("string") == "false")
    if months is not None:
        rows = rows.filter(F.col("competencia").cast("string").isin(*months))
    return rows.drop("quarantined", "competencia", "reason", "line")


def quarantine(spark: SparkSession, base: str) -> DataFrame:
    """(file_name, competencia, reason, line) of the lines that are no valid movements."""
    return spark.read.parquet(base).filter(F.col("quarantined").cast("string") == "true").select("file_name", "competencia", "reason", "line")


def family_columns(files: DataFrame, spec: Delivery = Delivery()) -> DataFrame:
    """(family, column_name, n_files, exclusive): which columns the files of each family bring.

    `files` are those of `manifest`, with headers; `exclusive` marks a column that no other
    family has. Names are compared as the scan compares them.
    """
    named = file_name_fields(files.filter("header is not null"), prefix=spec.prefix, years=spec.years).filter("recognised")
    names = F.transform(F.split(F.regexp_replace("header", "[\"\ufeff]", ""), re.escape(spec.sep)), lambda n: F.lower(F.trim(n)))
    long = named.select("family", "file", F.explode(names).alias("column_name"))
    counted = long.groupBy("family", "column_name").agg(F.countDistinct("file").alias("n_files"))
    families = counted.groupBy("column_name").agg(F.count(F.lit(1)).alias("_n"))
    return counted.join(families, "column_name").select("family", "column_name", "n_files", (F.col("_n") == 1).alias("exclusive"))
