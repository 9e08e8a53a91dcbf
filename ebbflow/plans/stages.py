"""The layers most queries start from, over the test tables or any movements."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ebbflow.operators.cohorts import cohort_month
from ebbflow.operators.features import silver
from ebbflow.operators.horizon import eligible, forward_window
from ebbflow.operators.labels import modelling_table, with_label
from ebbflow.operators.splits import hash_part
from ebbflow.settings import REGIONAL, Study
from ebbflow.sources.layers import materialise
from ebbflow.sources.samples import movements

COHORT_COLUMNS = ("month_seq", "region", "section", "age_band", "balance")


@dataclass(frozen=True)
class Stage:
    """A table and an upper bound on its rows, read from Parquet footers."""

    table: DataFrame
    rows: int


def cohorts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort_month(movements(spark, sf_dir, COHORT_COLUMNS))


def window_cohorts(cohorts: DataFrame, study: Study = REGIONAL) -> Stage:
    """Cohort-months with their forward counts, written once.

    Everything after this point reads the small table, never the movements.
    """
    stored = materialise(forward_window(cohorts, study.keys, study.outlook), "windowed")
    return Stage(stored, stored.count())


def label_cohorts(cohorts: DataFrame, study: Study = REGIONAL) -> Stage:
    windowed = window_cohorts(cohorts, study)
    kept = eligible(windowed.table, study.keys, study.outlook)
    return Stage(with_label(kept, study.keys, study.outlook), windowed.rows)


def windowed_stage(spark: SparkSession, sf_dir: str, study: Study = REGIONAL) -> Stage:
    return window_cohorts(cohorts_of(spark, sf_dir), study)


def eligible_stage(spark: SparkSession, sf_dir: str, study: Study = REGIONAL) -> Stage:
    windowed = windowed_stage(spark, sf_dir, study)
    return Stage(eligible(windowed.table, study.keys, study.outlook), windowed.rows)


def labelled_stage(spark: SparkSession, sf_dir: str, study: Study = REGIONAL) -> Stage:
    return label_cohorts(cohorts_of(spark, sf_dir), study)


def modelling_stage(spark: SparkSession, sf_dir: str, study: Study = REGIONAL) -> Stage:
    labelled = labelled_stage(spark, sf_dir, study)
    return Stage(modelling_table(labelled.table, study.keys), labelled.rows)


def silver_stage(spark: SparkSession, sf_dir: str, study: Study = REGIONAL) -> Stage:
    modelling = modelling_stage(spark, sf_dir, study)
    return Stage(silver(modelling.table, study), modelling.rows)


def parts_stage(spark: SparkSession, sf_dir: str, study: Study = REGIONAL) -> Stage:
    """Silver rows with their split part, written once: fits and metrics read it often."""
    rows = silver_stage(spark, sf_dir, study)
    stored = materialise(hash_part(rows.table, study.keys.columns), "parts")
    return Stage(stored, rows.rows)
