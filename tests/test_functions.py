from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from ebbflow import functions as fn


def values(df, column="out"):
    return [r[column] for r in df.collect()]


def test_age_band_edges(spark):
    ages = [None, 13, 14, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 64, 65, 99]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    assert values(df.select(fn.age_band(F.col("age")).alias("out"))) == [
        "DESCONHECIDO",
        "DESCONHECIDO",
        "14-17",
        "14-17",
        "18-24",
        "18-24",
        "25-34",
        "25-34",
        "35-44",
        "35-44",
        "45-54",
        "45-54",
        "55-64",
        "55-64",
        "65+",
        "65+",
    ]


def test_salary_band_edges_are_inclusive_above(spark):
    salaries = [None, -5.0, 0.0, 1412.0, 1412.01, 2824.0, 2824.01, 4236.0, 7060.0, 7060.01]
    df = spark.createDataFrame([(s,) for s in salaries], "salary double")
    assert values(df.select(fn.salary_band(F.col("salary")).alias("out"))) == [
        "ATE_1_SM",
        "ATE_1_SM",
        "ATE_1_SM",
        "ATE_1_SM",
        "1_A_2_SM",
        "1_A_2_SM",
        "2_A_3_SM",
        "2_A_3_SM",
        "3_A_5_SM",
        "MAIS_DE_5_SM",
    ]


@pytest.mark.parametrize(
    "edges, counts", [((20, 100), [20, 21, 100, 101]), ((25, 400), [25, 26, 400, 401])]
)
def test_volume_band_edges(spark, edges, counts):
    df = spark.createDataFrame([(c,) for c in counts], "n long")
    band = fn.volume_band(F.col("n"), edges, ("S", "M", "L"))
    assert values(df.select(band.alias("out"))) == ["S", "M", "M", "L"]


def test_numbers_never_raise(spark):
    texts = ["1412,50", "1.412,50", "abc", "", None, " 7 ", "25,9"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = values(df.select(fn.to_double(F.col("t")).alias("out")))
    grouped = values(df.select(fn.to_double(F.col("t"), ".").alias("out")))
    whole = values(df.select(fn.to_int(F.col("t")).alias("out")))
    assert plain == [1412.5, None, None, None, None, 7.0, 25.9]
    assert grouped == [1412.5, 1412.5, None, None, None, 7.0, 25.9]
    assert whole == [1412, None, None, None, None, 7, 25]


def test_only_plain_numbers_are_numbers(spark):
    texts = ["1d", "12f", "NaN", "Infinity", "-3", "+,5", "1e3", "0x10", "5.", "."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = values(df.select(fn.to_double(F.col("t")).alias("out")))
    assert plain == [None, None, None, None, -3.0, 0.5, 1000.0, None, 5.0, None]


def test_months_outside_the_year_have_no_ordinal(spark):
    df = spark.createDataFrame([("202413",), ("202400",), ("2024-1",), ("20241",), (" 202412 ",)], "m string")
    assert values(df.select(fn.month_ordinal("m").alias("out"))) == [None, None, None, None, 2024 * 12 + 12]


def test_month_ordinal_round_trip(spark):
    labels = ["199501", "202312", "202401", "202406", "x"]
    df = spark.createDataFrame([(m,) for m in labels], "m string")
    seq = df.select("m", fn.month_ordinal("m").alias("seq"))
    back = seq.select(
        fn.month_label("seq").alias("label"),
        fn.year_number("seq").alias("y"),
        fn.month_number("seq").alias("n"),
    ).collect()
    assert [tuple(r) for r in back] == [
        ("199501", 1995, 1),
        ("202312", 2023, 12),
        ("202401", 2024, 1),
        ("202406", 2024, 6),
        (None, None, None),
    ]
    assert values(seq, "seq")[1:3] == [2023 * 12 + 12, 2024 * 12 + 1]


def test_guarded_ratio_and_blank(spark):
    df = spark.createDataFrame(
        [(1, 4, "a", 1.0), (0, 0, " ", float("nan")), (3, 0, None, None)],
        "a int, b int, s string, d double",
    )
    rows = df.select(
        fn.guarded_ratio(F.col("a"), F.col("b")).alias("r"),
        fn.is_blank(F.col("s")).alias("s"),
        fn.is_blank(F.col("d"), "double").alias("d"),
    ).collect()
    assert [tuple(r) for r in rows] == [(0.25, False, False), (0.0, True, True), (0.0, True, True)]


def test_hash_percent_matches_md5(spark):
    df = spark.createDataFrame([(24001, "A"), (24002, "B")], "m int, s string")
    got = values(df.select(fn.hash_percent([F.col("m"), F.col("s")], 42).alias("out")))
    expected = [
        int(hashlib.md5(f"{m}|{s}|42".encode()).hexdigest()[:8], 16) % 100
        for m, s in ((24001, "A"), (24002, "B"))
    ]
    assert got == expected
