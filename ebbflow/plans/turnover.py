"""A whole study, from a folder of raw files to compared models.

Each step reads the Parquet layer before it and writes its own below `base`, so a
step can be repeated alone and an interrupted study resumes at a layer:

    deliveries/     status of each file       landed/    all lines, quarantined ones with a reason
    bronze/         movements by month        cohorts/   forward counts per cohort-month
    dominant/       labelled cohorts with their dominant occupation group
    occupations/    counts per cohort and occupation group
    target_audit/   labelled cohorts          modelling/ the same without the future
    silver/         features by year          models/    fitted pipelines
    metrics/        one row per model and run reports/   small summaries
    checks/         what each write should hold against what was read back
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.functions import age_band, leading_digits, salary_band
from ebbflow.operators import checks as ck
from ebbflow.operators import cohorts as co
from ebbflow.operators import horizon as ho
from ebbflow.operators import labels as la
from ebbflow.operators import learning as le
from ebbflow.operators import lineage as li
from ebbflow.operators import occupation as oc
from ebbflow.operators import profiling as pr
from ebbflow.operators import quality as qu
from ebbflow.operators.features import silver
from ebbflow.operators.splits import hash_part, split_report
from ebbflow.settings import REGIONAL, REGION_LABELS, Study
from ebbflow.sources import landing, sinks


def region_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(REGION_LABELS.items()), "region int, region_name string"
    )


def ingest(
    spark: SparkSession,
    folder: str,
    base: str,
    study: Study = REGIONAL,
    thousands_sep: str | None = None,
    glob: str = "*",
    prefix: str = "[A-Z]*",
) -> DataFrame:
    """The movement files of `folder` that are new to `base`, to `bronze`.

    One file per month is taken: the manifest, kept in `deliveries`, marks further copies,
    files read earlier and files that can't be read. Lines that are no valid movements stay
    in `landed` with a reason. The manifest is added last, so an interrupted run is done anew.
    """
    record = f"{base}/deliveries"
    done = sinks.read_table(spark, record).filter("status = 'new'").select("file_name") if sinks.table_exists(spark, record) else None
    spec = landing.Delivery(prefix=prefix, glob=glob, thousands_sep=thousands_sep)
    deliveries = landing.land(spark, folder, f"{base}/landed", done, spec, study.region_codes)
    # at most one row per calendar month
    months = sorted(r.month for r in deliveries.filter("status = 'new'").select("month").distinct().collect())
    if months:
        sinks.write_months(landing.movements(spark, f"{base}/landed", months), f"{base}/bronze", months=months)
    elif done is None:
        raise FileNotFoundError(f"no movement files in {folder}")
    deliveries.write.mode("append").parquet(record)
    return sinks.read_table(spark, f"{base}/bronze")


def _write(
    base: str, layer: str, df: DataFrame, write=sinks.write_table, label: str | None = None, exactly: int | None = None
) -> None:
    """Write a layer, compare it with what can be read back and keep the check."""
    ck.record(ck.write_checked(df, f"{base}/{layer}", layer, write, label, exactly), f"{base}/checks")


def banded(movements: DataFrame) -> DataFrame:
    """Movements with every column a cohort key may use."""
    return movements.withColumns(
        {
            "age_band": age_band(F.col("age")),
            "salary_band": salary_band(F.col("salary")),
            "occupation_group": leading_digits(F.col("occupation")),
        }
    )


def build_target(spark: SparkSession, base: str, study: Study = REGIONAL) -> DataFrame:
    """`bronze` to labelled cohorts: the movements are read once, for the occupation
    counts every later table derives from."""
    movements = banded(sinks.read_table(spark, f"{base}/bronze"))
    fine = co.fine_counts(movements, ["occupation_group"], study.keys)
    _write(base, "occupations", fine)
    counts = sinks.read_table(spark, f"{base}/occupations")
    windowed = ho.forward_window(co.roll_up(counts, study.keys), study.keys, study.outlook)
    _write(base, "cohorts", windowed)
    cohorts = sinks.read_table(spark, f"{base}/cohorts")
    kept = ho.eligible(cohorts, study.keys, study.outlook)
    labelled = la.with_label(kept, study.keys, study.outlook)
    _write(base, "target_audit", labelled, label=la.LABEL)
    audit = sinks.read_table(spark, f"{base}/target_audit")
    _write(base, "modelling", la.modelling_table(audit, study.keys), label=la.LABEL, exactly=audit.count())
    return audit


def build_silver(spark: SparkSession, base: str, study: Study = REGIONAL) -> DataFrame:
    """`modelling` to features; stops on a repeated key or a leaking feature."""
    modelling = sinks.read_table(spark, f"{base}/modelling")
    qu.require_unique(modelling, study.keys.columns)
    qu.require_no_leakage(study.features, study.outlook)
    features = li.require_clean_lineage(silver(modelling, study), study.features, study.outlook)
    by_year = lambda df, path: sinks.write_partitioned(df, path, "year")
    _write(base, "silver", features, by_year, study.features.label, exactly=modelling.count())
    return sinks.read_table(spark, f"{base}/silver")


def describe_study(spark: SparkSession, base: str, study: Study = REGIONAL) -> dict[str, DataFrame]:
    """The audits of every layer, as small DataFrames."""
    movements = banded(sinks.read_table(spark, f"{base}/bronze"))
    counts = sinks.read_table(spark, f"{base}/occupations")
    cohorts = sinks.read_table(spark, f"{base}/cohorts")
    audit = sinks.read_table(spark, f"{base}/target_audit")
    features = sinks.read_table(spark, f"{base}/silver")
    sinks.write_table(co.cohort_sizes(movements), f"{base}/sizes")
    sizes = sinks.read_table(spark, f"{base}/sizes")
    months = cohorts.groupBy("month_seq").agg(F.sum("n_total").alias("n_rows"))
    regions = cohorts.select("month_seq", "region", "n_total")
    dominant = oc.dominant_occupation(counts, study.keys.columns)
    # four reports read the join
    sinks.write_table(oc.dominant_join(audit, dominant, study.keys.columns), f"{base}/dominant")
    joined = sinks.read_table(spark, f"{base}/dominant")
    dimensions = {
        "year": F.substring("month", 1, 4),
        "month": F.col("month"),
        "region": F.col("region"),
        "section": F.col("section"),
    }
    return {
        "region_years": co.region_year_counts(regions, region_labels(spark), weight="n_total"),
        "months": co.month_coverage(months),
        "granularity": co.cohort_granularity(sizes),
        "thresholds": co.threshold_simulation(cohorts, study.size_thresholds),
        "censoring": ho.censoring_report(cohorts, study.keys, study.outlook),
        "classes": la.class_distribution(audit),
        "ties": la.threshold_ties(audit, study.keys, study.outlook),
        "indicator": la.indicator_quantiles(audit, study.outlook),
        "stability": la.label_stability(audit, dimensions),
        "blanks": pr.null_audit(features),
        "numbers": pr.numeric_profile(features, ["n_total", "n_pos", "n_neg"]),
        "categories": pr.category_profile(features, study.keys.profile),
        "keys": qu.key_report(features, study.keys.columns),
        "dominance": oc.dominance_quantiles(joined),
        "occupations": oc.occupation_rate(joined),
        "occupations_by_section": oc.occupation_rate(joined, ("occupation_group", "section"), 30, 15),
        "occupations_by_region": oc.occupation_rate(joined, ("occupation_group", "region"), 30, 10),
        "join": oc.join_fanout_audit(audit, dominant, study.keys.columns),
    }


def train(
    spark: SparkSession, base: str, study: Study = REGIONAL, tuned: bool = True, tasks: int = le.FIT_TASKS
) -> DataFrame:
    """Baseline, regression, forest and tuned forest on one split of `silver`.

    Models are saved, metrics appended under a new run number; returns the latest
    metrics of every model. A large training part wants more `tasks`: its rows are held
    in so many partitions, and with the same number a fit repeats.
    """
    features = study.features
    parts = hash_part(sinks.read_table(spark, f"{base}/silver"), study.keys.columns)
    sinks.write_table(parts, f"{base}/parts")
    parts = sinks.read_table(spark, f"{base}/parts")
    train_rows, test_rows = le.split_parts(parts)
    keys = study.keys.columns
    fitted = {
        "logistic_regression": le.fit(train_rows, le.logistic_regression(features), features, keys, tasks),
        "random_forest": le.fit(train_rows, le.random_forest(features), features, keys, tasks),
    }
    if tuned:
        best, records, seconds = le.tune(train_rows, features, keys=keys, tasks=tasks)
        fitted["random_forest_tuned"] = (best, seconds)
        sinks.write_report(le.tuning_grid_report(records, parts), f"{base}/reports/tuning_grid")
    rows = [le.baseline_row(parts, features.label)]
    for name, (model, seconds) in fitted.items():
        loaded = le.save_model(model, f"{base}/models/{name}")
        scored = le.scores(loaded, test_rows, features.label)
        rows.append(le.metrics_row(scored, name, seconds, features.label))
        vectors = le.predict(loaded, test_rows)
        if name == "logistic_regression":
            sinks.write_report(le.coefficients(loaded, vectors), f"{base}/reports/coefficients")
        else:
            importance = le.feature_importance(loaded, vectors, features)
            sinks.write_report(importance, f"{base}/reports/importance_{name}")
    metrics = sinks.store_metrics(reduce(DataFrame.unionByName, rows), f"{base}/metrics")
    sinks.write_report(le.recommended(metrics), f"{base}/reports/recommended")
    return metrics


def run(
    spark: SparkSession,
    folder: str,
    base: str,
    study: Study = REGIONAL,
    tuned: bool = True,
    tasks: int = le.FIT_TASKS,
) -> DataFrame:
    """Every step in order; returns the model metrics."""
    qu.require_rows(ingest(spark, folder, base, study), at_least=1)
    build_target(spark, base, study)
    build_silver(spark, base, study)
    for name, report in describe_study(spark, base, study).items():
        sinks.write_report(report, f"{base}/reports/{name}")
    metrics = train(spark, base, study, tuned, tasks)
    parts = sinks.read_table(spark, f"{base}/parts")
    sinks.write_report(split_report(parts, study.features.label), f"{base}/reports/split")
    return metrics
