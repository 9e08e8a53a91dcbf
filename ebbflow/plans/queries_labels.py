"""The indicator, the label and the tables a model may see."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ebbflow.operators import labels as la
from ebbflow.operators import splits as sp
from ebbflow.operators.features import silver
from ebbflow.operators.lineage import lineage_report
from ebbflow.operators.quality import leakage_audit, schema_diff
from ebbflow.operators.ranking import approximate_quantiles
from ebbflow.plans.registry import query
from ebbflow.plans.sql import COHORT_KEY, PROFILE, hash_percent, oracle
from ebbflow.plans.stages import (
    eligible_stage,
    labelled_stage,
    modelling_stage,
    parts_stage,
    silver_stage,
)
from ebbflow.settings import NATIONAL, REGIONAL


@query(
    "indicator_quantiles",
    oracle(
        "SELECT 'share_neg_6m' AS metric, "
        + ", ".join(
            f"quantile_disc(share_neg_6m, {p}) AS {name}"
            for name, p in la.INDICATOR_QUANTILES.items()
        )
        + " FROM eligible",
        "eligible",
    ),
)
def indicator_quantiles(spark, sf_dir):
    cohorts = eligible_stage(spark, sf_dir)
    return la.indicator_quantiles(cohorts.table)


@query(
    "indicator_quantiles_slotted",
    oracle(
        "SELECT 'share_neg_6m' AS metric, "
        + ", ".join(
            f"quantile_disc(share_neg_6m, {p}) AS {name}"
            for name, p in la.INDICATOR_QUANTILES.items()
        )
        + " FROM eligible",
        "eligible",
    ),
)
def indicator_quantiles_slotted(spark, sf_dir):
    """The same rows, as published earlier under this name."""
    return la.indicator_quantiles(eligible_stage(spark, sf_dir).table)


@query("indicator_quantiles_sketch")
def indicator_quantiles_sketch(spark, sf_dir):
    """From a mergeable sketch: ranks off by at most a ten-thousandth."""
    cohorts = eligible_stage(spark, sf_dir).table
    return approximate_quantiles(cohorts, [la.indicator()], la.INDICATOR_QUANTILES)


@query("turnover_label", oracle("SELECT * FROM labelled", "labelled"))
def turnover_label(spark, sf_dir):
    return labelled_stage(spark, sf_dir).table


@query(
    "turnover_label_train_scope",
    oracle(
        f"""SELECT month_seq, {PROFILE}, share_neg_6m, CASE WHEN share_neg_6m >
          (SELECT quantile_disc(share_neg_6m, 0.5) FROM eligible
           WHERE {hash_percent(COHORT_KEY)} < 70) THEN 1 ELSE 0 END AS high_turnover
        FROM eligible""",
        "eligible",
    ),
)
def turnover_label_train_scope(spark, sf_dir):
    study = replace(REGIONAL, outlook=replace(REGIONAL.outlook, threshold_scope="train"))
    labelled = labelled_stage(spark, sf_dir, study).table
    return labelled.select("month_seq", *study.keys.profile, "share_neg_6m", "high_turnover")


@query(
    "class_distribution",
    oracle(
        """SELECT high_turnover, count(*) AS n_cohorts,
        round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct FROM labelled GROUP BY 1""",
        "labelled",
    ),
)
def class_distribution(spark, sf_dir):
    return la.class_distribution(labelled_stage(spark, sf_dir).table)


@query(
    "threshold_ties",
    oracle(
        """SELECT cut AS threshold, count(*) AS n_cohorts,
        count(*) FILTER (WHERE share_neg_6m = cut) AS n_ties,
        round(count(*) FILTER (WHERE share_neg_6m = cut) / count(*) * 100, 6) AS pct_ties
        FROM eligible, (SELECT quantile_disc(share_neg_6m, 0.5) AS cut FROM eligible)
        GROUP BY cut""",
        "eligible",
    ),
)
def threshold_ties(spark, sf_dir):
    cohorts = eligible_stage(spark, sf_dir)
    return la.threshold_ties(cohorts.table)


_RATES = """count(*) AS n_cohorts, count(*) FILTER (WHERE high_turnover = 0) AS n_class_0,
    count(*) FILTER (WHERE high_turnover = 1) AS n_class_1,
    round(count(*) FILTER (WHERE high_turnover = 0) / count(*) * 100, 6) AS pct_class_0,
    round(count(*) FILTER (WHERE high_turnover = 1) / count(*) * 100, 6) AS pct_class_1"""

_DIMENSIONS = {
    "year": (lambda: F.substring("month", 1, 4), "substr(month, 1, 4)"),
    "month": (lambda: F.col("month"), "month"),
    "region": (lambda: F.col("region"), "region"),
    "section": (lambda: F.col("section"), "section"),
}


def _stability(name, column):
    def run(spark, sf_dir):
        return la.rate_by(labelled_stage(spark, sf_dir).table, column(), name)

    return run


for _name, (_column, _text) in _DIMENSIONS.items():
    query(
        f"label_stability_{_name}",
        oracle(f"SELECT {_text} AS {_name}, {_RATES} FROM labelled GROUP BY 1", "labelled"),
    )(_stability(_name, _column))


@query(
    "label_stability",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{name}' AS dimension, CAST({text} AS VARCHAR) AS member, {_RATES} "
            "FROM labelled GROUP BY ALL"
            for name, (_, text) in _DIMENSIONS.items()
        ),
        "labelled",
    ),
)
def label_stability(spark, sf_dir):
    dimensions = {name: column() for name, (column, _) in _DIMENSIONS.items()}
    return la.label_stability(labelled_stage(spark, sf_dir).table, dimensions)


@query("modelling_table", oracle("SELECT * FROM modelling", "modelling"))
def modelling_table(spark, sf_dir):
    return modelling_stage(spark, sf_dir).table


@query(
    "indicator_histogram",
    oracle(
        """SELECT CAST(b AS INTEGER) AS bin, count(e.share_neg_6m) AS n_cohorts
        FROM range(50) r(b) LEFT JOIN (SELECT share_neg_6m, least(floor(
          CASE WHEN high > low THEN (share_neg_6m - low) * 50 / (high - low) ELSE 0 END), 49) AS bin
          FROM eligible, (SELECT min(share_neg_6m) AS low, max(share_neg_6m) AS high
            FROM eligible)) e ON e.bin = b GROUP BY b""",
        "eligible",
    ),
)
def indicator_histogram(spark, sf_dir):
    return la.indicator_histogram(eligible_stage(spark, sf_dir).table)


def _rounded(df):
    """Transcendental columns to 9 digits: engines differ in the last bits."""
    names = [c for c in ("log_volume", "month_sin", "month_cos") if c in df.columns]
    return df.withColumns({c: F.round(c, 9) for c in names})


@query("silver_features", oracle("SELECT * FROM silver", "silver"))
def silver_features(spark, sf_dir):
    return _rounded(silver_stage(spark, sf_dir).table)


@query(
    "silver_features_national",
    oracle(
        """SELECT month, month_seq, region, section, age_band, n_total, n_pos, n_neg, log_volume,
        share_neg, share_pos, CASE WHEN n_total <= 25 THEN 'PEQUENA'
          WHEN n_total <= 400 THEN 'MEDIA' ELSE 'GRANDE' END AS volume_band, year,
        CASE WHEN month_no <= 3 THEN 'Q1' WHEN month_no <= 6 THEN 'Q2' WHEN month_no <= 9 THEN 'Q3'
          ELSE 'Q4' END AS quarter, substr(month, 5, 2) AS month_no, high_turnover
        FROM silver""",
        "silver",
    ),
)
def silver_features_national(spark, sf_dir):
    return _rounded(silver(modelling_stage(spark, sf_dir, NATIONAL).table, NATIONAL))


@query(
    "leakage_audit",
    oracle(
        """SELECT column_name, role, leak, n_filled FROM (SELECT count(*) AS n FROM labelled),
        (VALUES ('month', 'other'), ('month_seq', 'other'), ('region', 'feature'),
          ('section', 'feature'), ('age_band', 'feature'), ('n_total', 'feature'),
          ('n_pos', 'feature'), ('n_neg', 'feature'), ('n_total_6m', 'future'),
          ('n_pos_6m', 'future'), ('n_neg_6m', 'future'), ('share_neg_6m', 'future'),
          ('months_active', 'future'), ('months_observed', 'future'), ('has_future', 'future'),
          ('high_turnover', 'label')) v(column_name, role),
        (SELECT false AS leak), (SELECT count(share_neg_6m) AS n_filled FROM labelled)""",
        "labelled",
    ),
)
def audit_leakage(spark, sf_dir):
    table = labelled_stage(spark, sf_dir).table
    return leakage_audit(table, REGIONAL.features.columns, REGIONAL.features.label)


@query(
    "schema_diff",
    oracle(
        """SELECT table_name, n_rows, n_columns, exclusive_column FROM
        (SELECT count(*) AS n_rows FROM labelled),
        (VALUES ('target_audit', 16, 'has_future'), ('target_audit', 16, 'months_active'),
          ('target_audit', 16, 'months_observed'), ('target_audit', 16, 'n_neg_6m'),
          ('target_audit', 16, 'n_pos_6m'), ('target_audit', 16, 'n_total_6m'),
          ('target_audit', 16, 'share_neg_6m'), ('modelling', 9, NULL))
          v(table_name, n_columns, exclusive_column)""",
        "labelled",
    ),
)
def diff_schemas(spark, sf_dir):
    labelled = labelled_stage(spark, sf_dir).table
    return schema_diff({"target_audit": labelled, "modelling": la.modelling_table(labelled)})


@query(
    "hash_split",
    oracle(
        """SELECT part, count(*) AS n_rows, CAST(sum(n_total) AS BIGINT) AS n_movements,
        min(month) AS first_month, max(month) AS last_month FROM parts GROUP BY part""",
        "parts",
    ),
)
def hash_split(spark, sf_dir):
    parts = sp.hash_part(silver_stage(spark, sf_dir).table, REGIONAL.keys.columns)
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n_total").alias("n_movements"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
    )


@query("random_split")
def random_split(spark, sf_dir):
    return sp.split_report(sp.random_parts(parts_stage(spark, sf_dir).table.drop("part")))


_SPLIT = """count(*) AS n_rows,
    round(count(*) FILTER (WHERE high_turnover = 0) / count(*) * 100, 6) AS pct_class_0,
    round(count(*) FILTER (WHERE high_turnover = 1) / count(*) * 100, 6) AS pct_class_1,
    round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct_rows"""


@query("split_report", oracle(f"SELECT part, {_SPLIT} FROM parts GROUP BY part", "parts"))
def split_report(spark, sf_dir):
    return sp.split_report(sp.hash_part(silver_stage(spark, sf_dir).table, REGIONAL.keys.columns))


@query(
    "temporal_split",
    oracle(
        f"""SELECT part, {_SPLIT} FROM (SELECT *, CASE WHEN month_seq >= first THEN 'test'
          WHEN month_seq >= first - 6 THEN 'embargo' ELSE 'train' END AS part
          FROM modelling, (SELECT max(month_seq) - 11 AS first FROM modelling)) GROUP BY part""",
        "modelling",
    ),
)
def temporal_split(spark, sf_dir):
    return sp.split_report(sp.temporal_part(modelling_stage(spark, sf_dir).table))


@query(
    "hash_sample",
    oracle(
        f"""SELECT month_seq, {PROFILE}, share_neg_6m FROM eligible
        WHERE {hash_percent(COHORT_KEY)} < 30""",
        "eligible",
    ),
)
def hash_sample(spark, sf_dir):
    cohorts = eligible_stage(spark, sf_dir).table
    kept = sp.hash_sample(cohorts, REGIONAL.keys.columns, 30)
    return kept.select(*REGIONAL.keys.columns, "share_neg_6m")


_MADE = ("volume_ahead", "churn", "class_hint")


@query(
    "leakage_lineage",
    oracle(
        """SELECT column_name, role, leak, hidden_sources, n_filled FROM (SELECT count(*) AS n_filled FROM labelled),
        (VALUES ('month_seq', 'other', FALSE, ''), ('region', 'feature', FALSE, ''), ('section', 'feature', FALSE, ''),
          ('age_band', 'feature', FALSE, ''), ('n_total', 'feature', FALSE, ''), ('n_neg', 'feature', FALSE, ''),
          ('share_neg', 'feature', FALSE, ''), ('volume_ahead', 'feature', TRUE, 'n_total_6m'),
          ('churn', 'feature', TRUE, 'n_neg_6m,n_total_6m'), ('class_hint', 'feature', TRUE, 'high_turnover,share_neg_6m'),
          ('high_turnover', 'label', FALSE, 'high_turnover,share_neg_6m')) v(column_name, role, leak, hidden_sources)""",
        "labelled",
    ),
)
def leakage_lineage(spark, sf_dir):
    """A renamed and two derived columns of the future, found by what they are made from."""
    ahead = F.col("n_total_6m")
    table = labelled_stage(spark, sf_dir).table.select(
        *REGIONAL.keys.columns,
        "n_total",
        "n_neg",
        (F.col("n_neg") / F.col("n_total")).alias("share_neg"),
        ahead.alias("volume_ahead"),
        (F.col("n_neg_6m") / F.greatest(ahead, F.lit(1))).alias("churn"),
        (F.col("high_turnover") * 2).alias("class_hint"),
        "high_turnover",
    )
    used = [*REGIONAL.keys.profile, "n_total", "n_neg", "share_neg", *_MADE]
    return lineage_report(table, used, "high_turnover").drop("sources")
