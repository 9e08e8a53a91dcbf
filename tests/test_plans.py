"""What the physical plans must look like, and what skew must not change."""

from __future__ import annotations

import re
from collections import Counter
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ebbflow.operators import cohorts as co
from ebbflow.operators import evaluation as ev
from ebbflow.operators import occupation as oc
from ebbflow.operators.cleaning import in_regions
from ebbflow.settings import REGIONAL_CODES
from ebbflow.sources import sinks
from ebbflow.sources.samples import movements

JOINING = (
    "auc_rank_slotted",
    "baseline_metrics",
    "category_profile",
    "class_distribution",
    "cohort_granularity",
    "cohort_month",
    "dominant_join",
    "forward_window_join",
    "horizon_listing",
    "indicator_histogram",
    "indicator_quantiles_slotted",
    "ingest_manifest",
    "join_fanout_audit",
    "month_coverage",
    "numeric_profile",
    "region_year_counts",
    "threshold_ties",
    "turnover_label_train_scope",
    "type_sign_crosstab",
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def conf(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("name", JOINING)
def test_no_pairwise_join_whatever_the_sizes(spark, small, name):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(queries()[name](spark, small))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_cohort_scan_reads_five_columns(spark, small):
    rows = movements(spark, small, ["month_seq", "region", "section", "age_band", "balance"])
    text = plan(co.cohort_month(rows))
    scan = re.search(r"FileScan parquet \[(l_[^]]*)\]", text).group(1)
    assert re.sub(r"#\d+L?", "", scan).split(",") == [
        "l_suppkey",
        "l_quantity",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    ]
    assert "partial_count" in text


def test_region_filter_and_months_reach_the_scan(spark, tmp_path):
    base = str(tmp_path / "bronze")
    df = spark.createDataFrame(
        [("202401", 21), ("202401", 35), ("202402", 22)], "month string, region int"
    )
    sinks.write_months(df, base)
    stored = in_regions(sinks.read_table(spark, base), REGIONAL_CODES)
    text = plan(stored.filter(F.col("competencia") == 202401))
    assert "PushedFilters: [In(region, [21,22,23,24,25,26,27,28,29])]" in text
    assert "PartitionFilters: [isnotnull(competencia" in text


def test_top_one_is_limited_before_the_shuffle(spark, small):
    assert "WindowGroupLimit" in plan(queries()["dominant_occupation"](spark, small))
    assert "TakeOrderedAndProject" in plan(queries()["occupation_volume"](spark, small))


@pytest.fixture(scope="module")
def skewed(spark):
    """9,000 movements, a third of them in one cohort and one occupation."""
    base = spark.range(6000).select(
        (F.col("id") % 12 + 24000).cast("int").alias("month_seq"),
        (F.col("id") % 7).cast("int").alias("region"),
        F.when(F.col("id") % 2 == 0, "G").otherwise("C").alias("section"),
        F.lit("18-24").alias("age_band"),
        (F.col("id") % 23).cast("string").alias("occupation_group"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(-1).alias("balance"),
    )
    hot = spark.range(3000).select(
        F.lit(24003).alias("month_seq"),
        F.lit(3).alias("region"),
        F.lit("G").alias("section"),
        F.lit("18-24").alias("age_band"),
        F.lit("5").alias("occupation_group"),
        F.lit(-1).alias("balance"),
    )
    return base.unionByName(hot).cache()


def test_hot_cohort_counts(spark, skewed):
    rows = skewed.collect()
    keys = Counter((r.month_seq, r.region, r.section) for r in rows)
    exits = Counter((r.month_seq, r.region, r.section) for r in rows if r.balance == -1)
    got = co.cohort_month(skewed).collect()
    assert {(r.month_seq, r.region, r.section): r.n_total for r in got} == dict(keys)
    assert all(r.n_neg == exits[(r.month_seq, r.region, r.section)] for r in got)
    pairs = Counter((r.month_seq, r.region, r.section, r.occupation_group) for r in rows)
    best = {}
    for (*key, group), n in pairs.items():
        best[tuple(key)] = min(best.get(tuple(key), (0, "")), (-n, group))
    dominant = oc.dominant_occupation(co.fine_counts(skewed, ["occupation_group"])).collect()
    assert {
        (r.month_seq, r.region, r.section): (-r.n_group, r.occupation_group) for r in dominant
    } == best


def test_hot_score(spark):
    """A third of the rows share one score; every pair is still counted right."""
    df = spark.range(900).select(
        F.when(F.col("id") < 300, 0.5).otherwise((F.col("id") * 37 % 101) / 100).alias("score"),
        (F.col("id") % 3 == 0).cast("int").alias("high_turnover"),
    )
    rows = df.collect()
    pos = Counter(r.score for r in rows if r.high_turnover == 1)
    neg = Counter(r.score for r in rows if r.high_turnover == 0)
    won = sum(a * b * ((p > n) + (p == n) / 2) for p, a in pos.items() for n, b in neg.items())
    expected = won / (sum(pos.values()) * sum(neg.values()))
    assert ev.auc_rank(df).first().auc == pytest.approx(expected, abs=1e-12)
