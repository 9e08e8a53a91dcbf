from __future__ import annotations

import itertools
import random
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbflow.operators import cohorts as co
from ebbflow.operators import horizon as ho
from ebbflow.operators import labels as la
from ebbflow.operators import ranking as ra
from ebbflow.operators import sketches as sk
from ebbflow.operators import splits as sp
from ebbflow.settings import CohortKeys, Outlook

START = 2023 * 12 + 1
SCHEMA = (
    "month_seq int, region int, section string, age_band string, "
    "n_total long, n_pos long, n_neg long"
)


def cohort_rows(spark, months, counts=(4, 1, 3), profile=(21, "G", "18-24")):
    return spark.createDataFrame([(START + m - 1, *profile, *counts) for m in months], SCHEMA)


def by_month(df, *columns):
    return {r.month_seq - START + 1: tuple(r[c] for c in columns) for r in df.collect()}


def test_gap_month_uses_calendar_range(spark):
    months = [m for m in range(1, 13) if m != 5]
    out = ho.eligible(ho.forward_window(cohort_rows(spark, months)))
    got = by_month(out, "n_total_6m", "months_active", "months_observed")
    assert got[1] == (20, 5, 5)  # 2, 3, 4, 6, 7
    assert got[6] == (24, 6, 6)
    assert sorted(got) == [1, 2, 3, 4, 6]
    strict = Outlook(require_complete_horizon=True)
    kept = ho.eligible(ho.forward_window(cohort_rows(spark, months)), outlook=strict)
    assert sorted(by_month(kept, "n_total")) == [6]


def test_months_observed_is_about_the_data_not_the_profile(spark):
    busy = cohort_rows(spark, range(1, 9))
    quiet = cohort_rows(spark, [1, 8], profile=(22, "G", "18-24"))
    out = ho.eligible(ho.forward_window(busy.union(quiet)))
    row = out.filter("region = 22").first()
    assert (row.months_active, row.months_observed, row.n_total_6m) == (0, 6, 0)


def test_right_censoring_keeps_two_of_eight_months(spark):
    out = ho.eligible(ho.forward_window(cohort_rows(spark, range(1, 9))))
    assert by_month(out, "n_total_6m") == {1: (24,), 2: (24,)}
    report = ho.censoring_report(ho.forward_window(cohort_rows(spark, range(1, 9)))).first()
    assert (report.last_month, report.last_eligible_month) == ("202308", "202302")
    assert (report.cohorts_eligible, report.cohorts_excluded) == (2, 6)


def test_empty_future(spark):
    far = cohort_rows(spark, [20], profile=(22, "C", "65+"))
    out = la.with_label(ho.eligible(ho.forward_window(cohort_rows(spark, [1]).union(far))))
    row = out.first()
    assert (row.n_total_6m, row.share_neg_6m, row.has_future, row.high_turnover) == (0, 0.0, False, 0)


def test_median_tie_is_class_zero(spark):
    shares = [0.2, 0.5, 0.5, 0.8]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shares)], "month_seq int, share_neg_6m double")
    for rows in (None, 4):
        labelled = la.with_label(df)
        assert [r.high_turnover for r in labelled.orderBy("month_seq").collect()] == [0, 0, 0, 1]
        ties = la.threshold_ties(df).first()
        assert (ties.threshold, ties.n_ties, ties.pct_ties) == (0.5, 2, 50.0)


def random_cohorts(seed, n_months=20, density=0.6):
    rng = random.Random(seed)
    rows = []
    for region, section, band in itertools.product((21, 22), "GC", ("18-24", "65+")):
        for m in range(n_months):
            if rng.random() < density:
                pos, neg = rng.randint(0, 5), rng.randint(0, 5)
                rows.append((START + m, region, section, band, pos + neg, pos, neg))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_window_equals_join_and_brute_force(spark, seed):
    rows = random_cohorts(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    columns = ["month_seq", "region", "section", "age_band", "n_total_6m", "n_neg_6m", "months_active"]
    window = {tuple(r) for r in ho.forward_window(df).select(columns).collect()}
    join = {tuple(r) for r in ho.forward_window_join(df).select(columns).collect()}
    brute = set()
    for seq, *profile, _, _, _ in rows:
        ahead = [r for r in rows if list(r[1:4]) == profile and seq < r[0] <= seq + 6]
        brute.add(
            (seq, *profile, sum(r[4] for r in ahead), sum(r[6] for r in ahead), len(ahead))
        )
    assert window == join == brute


def test_join_form_accepts_repeated_keys(spark):
    df = cohort_rows(spark, [1, 1, 2, 3])
    out = ho.forward_window_join(df)
    assert sorted((r.month_seq - START + 1, r.n_total_6m) for r in out.collect()) == [
        (1, 8),
        (1, 8),
        (2, 4),
        (3, 0),
    ]


def discrete(values, p):
    ordered = sorted(values)
    rank = max(1, -(-round(p * 10_000) * len(ordered) // 10_000))
    return ordered[rank - 1]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 40), min_size=1, max_size=120))
def test_quantiles_match_sorting(spark, numbers):
    df = spark.createDataFrame([(n / 7,) for n in numbers], "v double")
    wanted = {"low": 0.01, "mid": 0.5, "high": 0.9, "top": 0.999}
    expected = [discrete([n / 7 for n in numbers], p) for p in wanted.values()]
    for rows in (None, len(numbers)):
        row = ra.exact_quantiles(df, ["v"], wanted).first()
        assert [row[k] for k in wanted] == expected


def test_slotted_running_totals_with_a_hot_value(spark):
    """A third of the rows share one value; one slot and many slots agree."""
    hot = spark.range(3000).select(F.lit(500).alias("v"), (F.col("id") % 3).alias("g"))
    rest = spark.range(6000).select((F.col("id") % 1000).alias("v"), (F.col("id") % 3).alias("g"))
    counts = hot.union(rest).groupBy("g", "v").count()
    a = ra.running_totals(counts, ["g"], "v", ["count"])
    b = ra.running_totals(counts, ["g"], "v", ["count"], values_per_slot=7)
    columns = ["g", "v", "count", "count_before", "count_all"]
    assert a.select(columns).exceptAll(b.select(columns)).isEmpty()
    assert a.count() == b.count() == counts.count()


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("v"))
    row = ra.approximate_quantiles(df, ["v"], {"p50": 0.5}).first()
    assert abs(row.p50 - 5000) <= 2


def test_fine_counts_roll_up_to_cohort_month(spark):
    rows = [
        (START, 21, "G", "18-24", "10", 1),
        (START, 21, "G", "18-24", "11", -1),
        (START, 21, "G", "18-24", "11", -1),
        (START + 1, 21, "G", "65+", "11", 1),
    ]
    schema = "month_seq int, region int, section string, age_band string, occupation_group string, balance int"
    df = spark.createDataFrame(rows, schema)
    direct = co.cohort_month(df)
    rolled = co.roll_up(co.fine_counts(df, ["occupation_group"]))
    assert {tuple(r) for r in direct.select(sorted(direct.columns)).collect()} == {
        tuple(r) for r in rolled.select(sorted(direct.columns)).collect()
    }


def test_cohort_sizes_need_nested_keys(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        co.cohort_sizes(df, {"A": ("a",), "B": ("b", "c")})


def test_missing_months(spark):
    months = [START, START + 1, START + 3]
    df = spark.createDataFrame([(m,) for m in months], "month_seq int")
    counts = co.records_per_month(df)
    assert [r.month for r in co.missing_months(counts).collect()] == ["202303"]
    wider = co.missing_months(counts, START, START + 4)
    assert sorted(r.month for r in wider.collect()) == ["202303", "202305"]


def test_threshold_simulation_keeps_an_empty_threshold(spark):
    df = spark.createDataFrame([(5,), (10,), (15,)], "n_total long")
    rows = {r.min_size: r for r in co.threshold_simulation(df, (1, 10, 100)).collect()}
    assert (rows[10].cohorts_after, rows[10].rows_kept) == (2, 25)
    assert (rows[100].cohorts_after, rows[100].rows_kept, rows[100].pct_rows_kept) == (0, 0, 0.0)


def test_region_year_table(spark):
    df = spark.createDataFrame([(2023 * 12 + 12, 21), (2024 * 12 + 1, 21), (2024 * 12 + 2, 22)], "month_seq int, region int")
    rows = {r.region: r for r in co.region_year_table(df, (2023, 2024, 2025)).collect()}
    assert (rows[21]["2023"], rows[21]["2024"], rows[21]["2025"], rows[21].total) == (1, 1, 0, 2)
    assert (rows[22]["2023"], rows[22].total) == (0, 1)


def test_train_scope_ignores_test_rows(spark):
    df = spark.createDataFrame(
        [(i, 21, "G", "18-24", i / 100) for i in range(100)],
        "month_seq int, region int, section string, age_band string, share_neg_6m double",
    )
    keys = CohortKeys()
    outlook = replace(Outlook(), threshold_scope="train")
    train = sp.hash_part(df, keys.columns).filter("part = 'train'")
    expected = discrete([r.share_neg_6m for r in train.collect()], 0.5)
    assert df.select(la.threshold(df, keys, outlook)).first()[0] == expected


def test_splits_ignore_layout(spark):
    df = spark.range(500).select((F.col("id") + START).alias("month_seq"), F.lit(1).alias("high_turnover"))
    one = sp.hash_part(df.repartition(1), ["month_seq"])
    many = sp.hash_part(df.repartition(7, F.rand(3)), ["month_seq"])
    assert one.exceptAll(many).isEmpty()
    report = {r.part: r.n_rows for r in sp.split_report(one).collect()}
    assert 300 < report["train"] < 400 and sum(report.values()) == 500
    sample = sp.hash_sample(df, ["month_seq"], 30).count()
    assert 110 < sample < 190


def test_temporal_split_has_an_embargo(spark):
    df = spark.range(36).select((F.col("id") + START).alias("month_seq"))
    parts = sp.temporal_part(df, test_months=12, embargo=6)
    bounds = {
        r.part: (r.lo - START, r.hi - START)
        for r in parts.groupBy("part").agg(F.min("month_seq").alias("lo"), F.max("month_seq").alias("hi")).collect()
    }
    assert bounds == {"train": (0, 17), "embargo": (18, 23), "test": (24, 35)}


def test_stability_in_one_pass_equals_single_dimensions(spark):
    df = spark.createDataFrame(
        [("202301", "G", 1), ("202302", "G", 0), ("202302", "C", 1)],
        "month string, section string, high_turnover int",
    )
    both = la.label_stability(df, {"month": F.col("month"), "section": F.col("section")})
    got = {(r.dimension, r.member): (r.n_cohorts, r.n_class_1) for r in both.collect()}
    assert got == {
        ("month", "202301"): (1, 1),
        ("month", "202302"): (2, 1),
        ("section", "G"): (2, 1),
        ("section", "C"): (1, 1),
    }


def test_running_totals_hold_no_edges_in_their_plan(spark):
    """However many files the values lie in, the plan is the same: nothing is listed or searched."""
    counts = spark.range(20_000).selectExpr("id % 3 as g", "cast(id as double) as v", "1L as n")
    plans = [
        ra.running_totals(counts, ["g"], "v", ["n"], values_per_slot=k)._jdf.queryExecution().optimizedPlan().toString()
        for k in (20_000, 100)
    ]
    assert "percentile" not in plans[0] and abs(len(plans[0]) - len(plans[1])) < 200
    many = ra.running_totals(counts, ["g"], "v", ["n"], values_per_slot=100)
    wrong = many.filter("n_before <> floor(v / 3) or n_all <> 20000 div 3 + if(g < 20000 % 3, 1, 0)")
    assert many.count() == 20_000 and wrong.isEmpty()


def test_sketches_by_month_merge_and_are_replaced(spark, tmp_path):
    rows = spark.range(30_000).selectExpr(
        "cast(202301 + id % 3 as string) as month", "cast(id as double) as x", "id % 700 as k", "cast(null as string) as none"
    )
    base = str(tmp_path / "s")
    sk.store_sketches(sk.month_sketches(rows, ["x"], ["k", "none"]), base)
    half = rows.filter("month = '202302' and x < 100")
    sk.store_sketches(sk.month_sketches(half, ["x"], ["k", "none"]), base)
    left = rows.filter("month <> '202302'").unionByName(half)
    stored = sk.read_sketches(spark, base)
    got = sk.merged_quantiles(stored, {"p50": 0.5, "p999": 0.999}).collect()
    assert [(r.metric, r.n) for r in got] == [("x", left.count())]
    for name, p in (("p50", 0.5), ("p999", 0.999)):
        off = left.agg(sk.rank_error(left, "x", F.lit(got[0][name]), p)).first()[0]
        assert off <= sk.RANK_ERROR
    counts = {r.column_name: r.n_distinct for r in sk.merged_distinct(stored).collect()}
    assert counts["none"] == 0 and abs(counts["k"] - 700) <= 14
    one = sk.merged_distinct(sk.read_sketches(spark, base, ["202302"])).collect()
    assert {r.column_name: r.n_distinct for r in one}["x"] == half.count()
