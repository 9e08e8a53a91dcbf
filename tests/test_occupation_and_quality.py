from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ebbflow.operators import occupation as oc
from ebbflow.operators import profiling as pr
from ebbflow.operators import quality as qu
from ebbflow.operators.cohorts import fine_counts
from ebbflow.operators.features import silver
from ebbflow.settings import NATIONAL, REGIONAL, FeatureSet

KEYS = ("month_seq", "region", "section", "age_band")
MOVES = "month_seq int, region int, section string, age_band string, occupation_group string, balance int"


def moves(spark, groups):
    rows = [(1, 21, "G", "18-24", g, 1) for g in groups]
    return fine_counts(spark.createDataFrame(rows, MOVES), ["occupation_group"])


def test_lower_code_wins_a_tie(spark):
    rows = oc.dominant_occupation(moves(spark, ["52", "41", "52", "41", "99"])).collect()
    assert len(rows) == 1
    assert (rows[0].occupation_group, rows[0].n_group, rows[0].n_cohort, rows[0].share) == ("41", 2, 5, 0.4)


def test_no_cohort_is_lost_in_the_dominant_join(spark, small):
    from ebbflow.plans.queries_occupation import _both

    labelled, dominant = _both(spark, small)
    joined = oc.dominant_join(labelled, dominant)
    assert joined.count() == labelled.count()
    assert not joined.filter("age_band = 'DESCONHECIDO'").isEmpty()


def test_fanout_audit_without_joining(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a")], "k int, band string")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, band string")
    short = oc.join_fanout_audit(left, right, ["k"]).first()
    assert (short.rows_joined, short.max_matches_per_row, short.multiplies) == (5, 2, True)
    assert short.rows_left_unmatched == 1
    full = oc.join_fanout_audit(left, right, ["k", "band"]).first()
    assert (full.rows_joined, full.multiplies) == (3, False)


def test_support_filter(spark):
    rows = [("10", 1, 0.5, 2)] * 3 + [("11", 0, 0.5, 2)] * 2
    joined = spark.createDataFrame(rows, "occupation_group string, high_turnover int, share double, n_total long")
    got = oc.occupation_rate(joined, min_cohorts=3).collect()
    assert [(r.occupation_group, r.pct_class_1, r.volume) for r in got] == [("10", 100.0, 6)]
    assert oc.occupation_rate(joined, min_cohorts=1, top=None).count() == 2


def test_null_audit_counts_all_kinds_of_blank(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), ("", float("nan"), None), (" ", None, 2)], "s string, d double, i int"
    )
    got = [(r.column_name, r.n_blank) for r in pr.null_audit(df).collect()]
    assert got == [("d", 2), ("s", 2), ("i", 1)]


def test_category_profile_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    got = {(r.kind, r.position): (r.value, r.n, r.pct) for r in pr.category_profile(df, ["v"]).collect()}
    assert got == {
        ("top", 1): ("c", 2, 50.0),
        ("top", 2): ("a", 1, 25.0),
        ("top", 3): ("b", 1, 25.0),
        ("rarest", 1): ("a", 1, 25.0),
    }


def test_cardinality_modes(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "x string, y int")
    for approximate in (False, True):
        got = {r.column_name: r.n_distinct for r in pr.cardinality(df, ["x", "y"], approximate).collect()}
        assert got == {"x": 2, "y": 1}


def test_gates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [(r.k, r.n) for r in qu.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    with pytest.raises(qu.ExpectationError):
        qu.require_unique(df, ["k"])
    with pytest.raises(qu.ExpectationError):
        qu.require_rows(df, exactly=4)
    with pytest.raises(qu.ExpectationError):
        qu.require_rows(df, at_least=500_000)
    assert qu.require_rows(df, exactly=3) is df
    qu.require_no_leakage(REGIONAL.features)
    with pytest.raises(qu.ExpectationError):
        qu.require_no_leakage(FeatureSet(("region",), ("share_neg_6m",)))


def test_leakage_audit_flags_future_features(spark):
    df = spark.createDataFrame([(1, 0.5, 1)], "n_total int, share_neg_6m double, high_turnover int")
    rows = qu.leakage_audit(df, ["n_total", "share_neg_6m"], "high_turnover").collect()
    assert {r.column_name: (r.role, r.leak) for r in rows} == {
        "n_total": ("feature", False),
        "share_neg_6m": ("future", True),
        "high_turnover": ("label", False),
    }


def test_schema_diff(spark):
    mov = spark.createDataFrame([(1, 2)], "a int, b int")
    exc = spark.createDataFrame([(1, 2, 3), (4, 5, 6)], "a int, b int, reason int")
    rows = {(r.table_name, r.n_rows, r.n_columns, r.exclusive_column) for r in qu.schema_diff({"MOV": mov, "EXC": exc}).collect()}
    assert rows == {("MOV", 1, 2, None), ("EXC", 2, 3, "reason")}


def test_attrition(spark):
    df = spark.range(10)
    counts = qu.stage_counts(df, {"all": None, "even": F.col("id") % 2 == 0})
    rows = qu.attrition(counts, minimum=8).orderBy("step").collect()
    assert [(r.stage, r.rows_before, r.rows_after, r.rows_removed, r.pct_kept, r.enough_rows) for r in rows] == [
        ("all", 10, 10, 0, 100.0, True),
        ("even", 10, 5, 5, 50.0, False),
    ]


def test_silver_layouts(spark):
    schema = (
        "month string, month_seq int, region int, section string, age_band string, "
        "n_total long, n_pos long, n_neg long, high_turnover int"
    )
    df = spark.createDataFrame([("202403", 2024 * 12 + 3, 21, "G", "18-24", 25, 10, 15, 1)], schema)
    row = silver(df, REGIONAL).first()
    assert (row.region, row.volume_band, row.quarter, row.month_no, row.year) == ("21", "MEDIO", 1, 3, 2024)
    assert row.share_neg == 0.6 and abs(row.month_sin - 1.0) < 1e-12
    national = silver(df, NATIONAL)
    row = national.first()
    assert (row.volume_band, row.quarter, row.month_no) == ("PEQUENA", "Q1", "03")
    assert "month_sin" not in national.columns
    assert set(NATIONAL.features.columns) <= set(national.columns)
    assert set(REGIONAL.features.columns) <= set(silver(df, REGIONAL).columns)


def test_dominance_key_is_the_whole_cohort(spark):
    rows = [(1, 21, "G", b, g, 1) for b, g in (("18-24", "52"), ("65+", "41"), ("65+", "41"))]
    counts = fine_counts(spark.createDataFrame(rows, MOVES), ["occupation_group"])
    got = {r.age_band: r.occupation_group for r in oc.dominant_occupation(counts, KEYS).collect()}
    assert got == {"18-24": "52", "65+": "41"}
