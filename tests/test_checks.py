"""Writes compared with what can be read back."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ebbflow.operators import checks as ck
from ebbflow.operators.quality import ExpectationError
from ebbflow.sources import sinks


@pytest.fixture()
def rows(spark):
    return spark.range(4000).selectExpr(
        "id", "cast(id % 3 as int) as year", "if(id % 5 = 0, null, id / 7) as x", "cast(id % 2 as int) as label", "array(id) as a"
    ).repartition(4)


def parts(base):
    return sorted(Path(base).rglob("*.parquet"))


@pytest.mark.parametrize("by_year", [False, True])
def test_a_sound_write_is_reported(rows, tmp_path, by_year):
    write = (lambda df, path: sinks.write_partitioned(df, path, "year")) if by_year else sinks.write_table
    base = str(tmp_path / "t")
    row = ck.write_checked(rows, base, "layer", write, "label", exactly=4000).first()
    assert row.ok and row.same_content and (row.rows_written, row.rows_read, row.n_label_1_read) == (4000, 4000, 2000)


def test_an_empty_table_and_one_without_a_label(rows, tmp_path):
    row = ck.write_checked(rows.limit(0), str(tmp_path / "e"), "empty").first()
    assert row.ok and row.rows_read == 0 and row.n_label_1_read is None


@pytest.mark.parametrize("harm", ["truncated", "missing", "doubled", "changed"])
def test_a_harmed_write_stops_the_run(spark, rows, tmp_path, harm):
    base = str(tmp_path / "t")

    def write(df, path):
        sinks.write_table(df, path)
        first = parts(path)[0]
        if harm == "truncated":
            first.write_bytes(first.read_bytes()[: first.stat().st_size // 2])
        elif harm == "missing":
            first.unlink()
        elif harm == "doubled":
            first.with_name("part-copy.parquet").write_bytes(first.read_bytes())
        else:
            spark.read.parquet(path).withColumn("x", F.col("x") + 1).write.parquet(f"{path}2")
            for p in parts(path):
                p.unlink()
            for p in parts(f"{path}2"):
                p.rename(Path(path) / p.name)
        for crc in Path(path).glob(".*.crc"):
            crc.unlink()

    with pytest.raises(ExpectationError, match="layer"):
        ck.write_checked(rows, base, "layer", write, "label")


def test_a_pinned_number_of_rows(rows, tmp_path):
    with pytest.raises(ExpectationError):
        ck.write_checked(rows, str(tmp_path / "t"), "layer", exactly=3999)


def test_a_table_that_is_harmed_later(spark, rows, tmp_path):
    base, report = str(tmp_path / "t"), str(tmp_path / "checks")
    ck.record(ck.write_checked(rows, base, "layer"), report)
    stored = spark.read.parquet(report)
    ck.verify(spark, base, "layer", stored)
    with pytest.raises(ExpectationError, match="no check"):
        ck.verify(spark, base, "other", stored)
    parts(base)[0].unlink()
    with pytest.raises(ExpectationError, match="rows are left"):
        ck.verify(spark, base, "layer", stored)
    last = parts(base)[0]
    for crc in Path(base).glob(".*.crc"):
        crc.unlink()
    last.write_bytes(last.read_bytes()[:-400])
    with pytest.raises(ExpectationError, match="can't be read"):
        ck.verify(spark, base, "layer", stored)
