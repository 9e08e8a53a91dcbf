"""Metrics of rule-based predictions (exact oracles) and fitted models."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.operators import evaluation as ev
from ebbflow.operators import exported as ex
from ebbflow.operators import learning as le
from ebbflow.plans.registry import query
from ebbflow.plans.sql import COHORT_KEY, hash_percent, oracle
from ebbflow.plans.stages import parts_stage, silver_stage
from ebbflow.settings import NATIONAL, REGIONAL
from ebbflow.sources.layers import materialise, new_path
from ebbflow.sources.sinks import upsert_metrics

FEATURES = REGIONAL.features


def _cells(source: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE high_turnover = 0 AND prediction = 0) AS tn,
    count(*) FILTER (WHERE high_turnover = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE high_turnover = 1 AND prediction = 0) AS fn,
    count(*) FILTER (WHERE high_turnover = 1 AND prediction = 1) AS tp FROM {source}"""


def _ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN ({part}) / ({whole}) ELSE 0.0 END"


_RATES = f"""tn, fp, fn, tp,
    round({_ratio("tp + tn", "(tn + fp + fn + tp)")}, 9) AS accuracy,
    round({_ratio("tp", "(tp + fp)")}, 9) AS precision_pos,
    round({_ratio("tp", "(tp + fn)")}, 9) AS recall_pos,
    round({_ratio("2 * tp", "(2 * tp + fp + fn)")}, 9) AS f1_pos,
    round({_ratio("tn", "(tn + fp)")}, 9) AS specificity,
    round(({_ratio("tp + fn", "(tn + fp + fn + tp)")}) * ({_ratio("tp", "(tp + fp)")})
      + ({_ratio("tn + fp", "(tn + fp + fn + tp)")}) * ({_ratio("tn", "(tn + fn)")}), 9)
      AS weighted_precision,
    round({_ratio("tp + tn", "(tn + fp + fn + tp)")}, 9) AS weighted_recall"""


def _rounded(metrics: DataFrame) -> DataFrame:
    rates = [c for c, t in metrics.dtypes if t == "double"]
    return metrics.withColumns({c: F.round(c, 9) for c in rates})


@query("confusion_matrix", oracle(_cells("pred"), "pred"))
def confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(ev.rule_predictions(parts_stage(spark, sf_dir).table))


@query("classification_metrics", oracle(f"SELECT {_RATES} FROM ({_cells('pred')})", "pred"))
def classification_metrics(spark, sf_dir):
    predictions = ev.rule_predictions(parts_stage(spark, sf_dir).table)
    return _rounded(ev.classification_metrics(ev.confusion_matrix(predictions)))


@query(
    "baseline_metrics",
    oracle(
        f"""SELECT {_RATES} FROM ({_cells('''(SELECT high_turnover, (SELECT high_turnover
          FROM parts WHERE part = 'train' GROUP BY high_turnover
          ORDER BY count(*) DESC, high_turnover LIMIT 1) AS prediction
          FROM parts WHERE part = 'test')''')})""",
        "parts",
    ),
)
def baseline_metrics(spark, sf_dir):
    predictions = ev.baseline_predictions(parts_stage(spark, sf_dir).table)
    return _rounded(ev.classification_metrics(ev.confusion_matrix(predictions)))


# the probability that a positive outranks a negative, by mean ranks
_AUC = """SELECT max(p) AS n_pos, max(n) AS n_neg,
    round((sum(r) - max(p) * (max(p) + 1) / 2) / (max(p) * max(n)), 9) AS auc
    FROM (SELECT CASE WHEN high_turnover = 1 THEN lo + (ties - 1) / 2 END AS r,
      count(*) FILTER (WHERE high_turnover = 1) OVER () AS p,
      count(*) FILTER (WHERE high_turnover = 0) OVER () AS n
      FROM (SELECT high_turnover, rank() OVER (ORDER BY score) AS lo,
        count(*) OVER (PARTITION BY score) AS ties FROM pred))"""


@query("auc_rank", oracle(_AUC, "pred"))
def auc_rank(spark, sf_dir):
    parts = parts_stage(spark, sf_dir)
    predictions = ev.rule_predictions(parts.table)
    return ev.auc_rank(predictions).withColumn("auc", F.round("auc", 9))


@query("auc_rank_slotted", oracle(_AUC, "pred"))
def auc_rank_slotted(spark, sf_dir):
    """The same rows from the stored parts, as published earlier under this name."""
    predictions = ev.rule_predictions(parts_stage(spark, sf_dir).table)
    return ev.auc_rank(predictions).withColumn("auc", F.round("auc", 9))


@query(
    "category_index",
    oracle(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, {c} AS value, count(*) AS n,
            CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) AS "index"
            FROM silver GROUP BY {c}"""
            for c in FEATURES.categorical
        ),
        "silver",
    ),
)
def category_index(spark, sf_dir):
    return ev.category_index(silver_stage(spark, sf_dir).table, list(FEATURES.categorical))


_WIDTH = " + ".join(f"count(DISTINCT {c})" for c in FEATURES.categorical)


@query(
    "vector_width",
    oracle(
        f"""SELECT {_WIDTH} AS n_category_slots, CAST(0 AS BIGINT) AS n_spare_slots,
        CAST({len(FEATURES.numeric)} AS BIGINT) AS n_numeric,
        {_WIDTH} + {len(FEATURES.numeric)} AS vector_width FROM silver""",
        "silver",
    ),
)
def vector_width(spark, sf_dir):
    rows = silver_stage(spark, sf_dir).table
    return ev.vector_width(rows, list(FEATURES.categorical), list(FEATURES.numeric))


_CUTS = (0.4, 0.5, 0.6)


def _rule_row(parts: DataFrame, cut: float, run: int) -> DataFrame:
    rates = ev.classification_metrics(ev.confusion_matrix(ev.rule_predictions(parts, cut)))
    return rates.select(
        F.lit(f"rule_{cut}").alias("model"),
        F.lit(run).alias("run"),
        F.round("accuracy", 9).alias("accuracy"),
        F.round("f1_pos", 9).alias("f1_pos"),
    )


def _rule_sql(name: str, cut: float, run: int) -> str:
    source = f"""(SELECT high_turnover, CASE WHEN share_neg > {cut} THEN 1 ELSE 0 END AS prediction
      FROM parts WHERE part = 'test')"""
    return f"""SELECT '{name}' AS model, {run} AS run, accuracy, f1_pos
    FROM (SELECT {_RATES} FROM ({_cells(source)}))"""


@query(
    "metrics_upsert",
    oracle(
        " UNION ALL ".join(
            [_rule_sql("rule_0.4", 0.4, 1), _rule_sql("rule_0.5", 0.5, 2), _rule_sql("rule_0.6", 0.6, 2)]
        ),
        "parts",
    ),
)
def metrics_upsert(spark, sf_dir):
    """Run 1 stored two rules; run 2 brings one of them again and a new one."""
    parts = parts_stage(spark, sf_dir).table
    first = _rule_row(parts, 0.4, 1).unionByName(_rule_row(parts, 0.5, 1))
    second = _rule_row(parts, 0.5, 2).unionByName(_rule_row(parts, 0.6, 2))
    return upsert_metrics(first, second)


def _fitted(spark, sf_dir, classifier):
    """The fitted pipeline, its test rows, its seconds and a bound on the rows."""
    parts = parts_stage(spark, sf_dir)
    train, test = le.split_parts(parts.table)
    model, seconds = le.fit(train, classifier)
    return model, test, seconds, parts.rows


def _metrics(spark, sf_dir, classifier, name):
    model, test, seconds, n = _fitted(spark, sf_dir, classifier)
    scored = le.scores(model, test)
    row = le.metrics_row(scored, name, seconds)
    return row.withColumn("auc_binned", F.lit(le.area_under_roc(scored)))


@query("lr_metrics")
def lr_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, le.logistic_regression(), "logistic_regression")


@query("rf_metrics")
def rf_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir, le.random_forest(), "random_forest")


@query("national_lr_metrics")
def national_lr_metrics(spark, sf_dir):
    """The other parameterisation: numeric first, unknown categories kept."""
    features = NATIONAL.features
    parts = parts_stage(spark, sf_dir, NATIONAL)
    train, test = le.split_parts(parts.table)
    model, seconds = le.fit(train, le.logistic_regression(features), features)
    return le.metrics_row(le.scores(model, test), "logistic_regression", seconds)


@query("model_comparison")
def model_comparison(spark, sf_dir):
    """Baseline, regression and forest on one split, the recommended one marked."""
    parts = parts_stage(spark, sf_dir)
    train, test = le.split_parts(parts.table)
    rows = [le.baseline_row(parts.table)]
    for name, classifier in (
        ("logistic_regression", le.logistic_regression()),
        ("random_forest", le.random_forest()),
    ):
        model, seconds = le.fit(train, classifier)
        rows.append(le.metrics_row(le.scores(model, test), name, seconds))
    # a few rows, each from its own model: evaluated once, then compared
    metrics = materialise(reduce(DataFrame.unionByName, rows), "metrics")
    best = le.recommended(metrics).select("model").scalar()
    return metrics.withColumn("recommended", F.col("model") == best)


_SLOT_NAMES = " UNION ALL ".join(
    [
        f"SELECT {i} AS part, count(*) AS n, '{c}_ohe_' || {c} AS name FROM silver GROUP BY {c}"
        for i, c in enumerate(FEATURES.categorical)
    ]
    + [f"SELECT {100 + i}, 0, '{c}'" for i, c in enumerate(FEATURES.numeric)]
)


@query(
    "feature_names",
    oracle(
        f"""SELECT CAST(row_number() OVER (ORDER BY part, n DESC, name) - 1 AS INTEGER) AS slot, name
        FROM ({_SLOT_NAMES})""",
        "silver",
    ),
)
def feature_names(spark, sf_dir):
    """Slot and name of the assembled vector, read from its metadata."""
    rows = silver_stage(spark, sf_dir).table
    vectors = Pipeline(stages=le.feature_stages()).fit(rows).transform(rows)
    return le.feature_names(vectors)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    model, test, *_ = _fitted(spark, sf_dir, le.random_forest())
    return le.feature_importance(model, le.predict(model, test))


@query("source_importance")
def source_importance(spark, sf_dir):
    model, test, *_ = _fitted(spark, sf_dir, le.random_forest())
    return le.source_importance(le.feature_importance(model, le.predict(model, test)))


@query("lr_coefficients")
def lr_coefficients(spark, sf_dir):
    model, test, *_ = _fitted(spark, sf_dir, le.logistic_regression())
    return le.coefficients(model, le.predict(model, test))


@query("tuning_report")
def tuning_report(spark, sf_dir):
    """Validation AUC of the eight combinations, best first."""
    parts = parts_stage(spark, sf_dir)
    train, test = le.split_parts(parts.table)
    model, records, _ = le.tune(train)
    return le.tuning_grid_report(records, le.predict(model, test))


@query("tuning_comparison")
def tuning_comparison(spark, sf_dir):
    """Base forest against the tuned one on the test part, metric by metric."""
    parts = parts_stage(spark, sf_dir)
    n = parts.rows
    train, test = le.split_parts(parts.table)
    base, base_seconds = le.fit(train, le.random_forest())
    tuned, _, tuned_seconds = le.tune(train)
    return le.tuning_comparison(
        le.metrics_row(le.scores(base, test), "random_forest", base_seconds),
        le.metrics_row(le.scores(tuned, test), "random_forest_tuned", tuned_seconds),
    )


@query(
    "model_reload",
    oracle("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM parts WHERE part = 'test'", "parts"),
)
def model_reload(spark, sf_dir):
    """Save, load, predict: rows where the loaded model disagrees (must be none)."""
    model, test, *_ = _fitted(spark, sf_dir, le.logistic_regression())
    loaded = le.save_model(model, new_path(spark, "model"))
    keys = list(le.COHORT_KEY)
    first = le.predict(model, test).select(*keys, "prediction")
    again = le.predict(loaded, test).select(*keys, F.col("prediction").alias("_again"))
    return first.join(again, keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("prediction") != F.col("_again")).alias("n_different"),
    )


_SAME = oracle(
    """SELECT month_seq, region, section, age_band, TRUE AS same_score, TRUE AS same_class
    FROM parts WHERE part = 'test'""",
    "parts",
)


@query("lr_scores_sql", _SAME)
def lr_scores_sql(spark, sf_dir):
    """Every test row scored from the exported coefficients, beside MLlib's score."""
    model, test, *_ = _fitted(spark, sf_dir, le.logistic_regression())
    scored = ex.regression_scores(le.predict(model, test), ex.regression_table(spark, model))
    return ex.agreement(scored, le.COHORT_KEY)


@query("rf_scores_sql", _SAME)
def rf_scores_sql(spark, sf_dir):
    """Every test row scored from the exported tree nodes, beside MLlib's score."""
    model, test, *_ = _fitted(spark, sf_dir, le.random_forest())
    slots = ex.vector_slots(spark, model)
    scored = ex.forest_scores(le.predict(model, test), ex.forest_table(spark, model), slots)
    return ex.agreement(scored, le.COHORT_KEY)


@query(
    "lr_calibration",
    oracle(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, {c} AS value, count(*) AS n_rows,
            CAST(sum(high_turnover) AS BIGINT) AS n_pos, CAST(sum(high_turnover) AS BIGINT) AS expected_pos
            FROM parts WHERE part = 'train' GROUP BY {c}"""
            for c in FEATURES.categorical
        ),
        "parts",
    ),
)
def lr_calibration(spark, sf_dir):
    """The regression at its optimum expects the positives of every category that there are."""
    train, _ = le.split_parts(parts_stage(spark, sf_dir).table)
    model, _ = le.fit(train, le.logistic_regression().setMaxIter(1000).setTol(1e-12))
    return ex.calibration(le.predict(model, train), FEATURES.categorical)


_ENTROPY = "-(q * ln(q) + (1 - q) * ln(1 - q))"


@query(
    "model_bounds",
    oracle(
        " UNION ALL ".join(
            f"""SELECT '{m}' AS model, '{measure}' AS measure, n_rows, n_pos, round({null}, 9) AS by_base_rate,
            TRUE AS fits_better FROM (SELECT count(*) AS n_rows, CAST(sum(high_turnover) AS BIGINT) AS n_pos,
            avg(high_turnover) AS q FROM parts WHERE part = 'train')"""
            for m, measure, null in (
                ("logistic_regression", "log_loss", _ENTROPY),
                ("random_forest", "brier", "q * (1 - q)"),
            )
        ),
        "parts",
    ),
)
def model_bounds(spark, sf_dir):
    """What the fits lose on their own rows, against the base rate that each could have kept."""
    train, _ = le.split_parts(parts_stage(spark, sf_dir).table)
    rows = []
    for name, classifier, measure in (
        ("logistic_regression", le.logistic_regression(), "log_loss"),
        ("random_forest", le.random_forest(), "brier"),
    ):
        model, _ = le.fit(train, classifier)
        quality = ex.fit_quality(le.predict(model, train))
        rows.append(
            quality.select(
                F.lit(name).alias("model"),
                F.lit(measure).alias("measure"),
                "n_rows",
                "n_pos",
                F.round(f"null_{measure}", 9).alias("by_base_rate"),
                (F.col(measure) <= F.col(f"null_{measure}")).alias("fits_better"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


_CONFUSED = oracle(
    """SELECT model, count(*) FILTER (WHERE high_turnover = 0) AS n_neg,
      count(*) FILTER (WHERE high_turnover = 1) AS n_pos, TRUE AS rates_follow, TRUE AS auc_in_range
    FROM parts, (VALUES ('baseline'), ('logistic_regression'), ('random_forest')) m(model)
    WHERE part = 'test' GROUP BY model""",
    "parts",
)


@query("model_comparison_checked", _CONFUSED)
def model_comparison_checked(spark, sf_dir):
    """The comparison's cells add up to the test rows and its rates follow from the cells."""
    m = model_comparison(spark, sf_dir)
    near = lambda rate, part, whole: F.abs(F.col(rate) - F.coalesce(F.expr(f"({part}) / nullif({whole}, 0)"), F.lit(0.0))) <= 1e-6
    follow = (
        near("accuracy", "tp + tn", "tp + tn + fp + fn")
        & near("precision_pos", "tp", "tp + fp")
        & near("recall_pos", "tp", "tp + fn")
        & near("f1_pos", "2 * tp", "2 * tp + fp + fn")
    )
    return m.select(
        "model",
        (F.col("tn") + F.col("fp")).alias("n_neg"),
        (F.col("fn") + F.col("tp")).alias("n_pos"),
        follow.alias("rates_follow"),
        F.col("auc_roc").between(0, 1).alias("auc_in_range"),
    )


_SOURCES = " UNION ALL ".join(
    [f"SELECT '{c}' AS source, count(DISTINCT {c}) AS n_slots FROM parts WHERE part = 'train'" for c in FEATURES.categorical]
    + [f"SELECT '{c}', CAST(1 AS BIGINT)" for c in FEATURES.numeric]
)


@query("importance_bounds", oracle(f"SELECT source, n_slots, TRUE AS in_range, 1.0::DOUBLE AS total FROM ({_SOURCES})", "parts"))
def importance_bounds(spark, sf_dir):
    """Slots of each source and whether the importances are shares of one."""
    found = materialise(source_importance(spark, sf_dir), "importance")
    total = found.agg(F.round(F.sum("importance"), 9)).scalar()
    return found.select("source", "n_slots", F.col("importance").between(0, 1).alias("in_range"), total.alias("total"))


_GRID = """(VALUES (1, 20, 5, 1), (2, 20, 5, 5), (3, 20, 8, 1), (4, 20, 8, 5), (5, 30, 5, 1), (6, 30, 5, 5),
    (7, 30, 8, 1), (8, 30, 8, 5)) g(combination, trees, depth, min_instances)"""


@query(
    "tuning_report_checked",
    oracle(
        f"""SELECT combination, trees, depth, min_instances, n_fit, n_validation, TRUE AS auc_in_range
        FROM {_GRID}, (SELECT count(*) FILTER (WHERE h < 70) AS n_fit, count(*) FILTER (WHERE h >= 70) AS n_validation
          FROM (SELECT {hash_percent(COHORT_KEY, 43)} AS h FROM parts WHERE part = 'train'))""",
        "parts",
    ),
)
def tuning_report_checked(spark, sf_dir):
    """The grid with the rows that each combination was fitted and judged on."""
    train, _ = le.split_parts(parts_stage(spark, sf_dir).table)
    fit_rows, validation = le.tuning_cut(train)
    _, records, _ = le.tune(train)
    report = le.tuning_grid_report(records, train)
    return report.select(
        "combination",
        "trees",
        "depth",
        "min_instances",
        fit_rows.agg(F.count(F.lit(1))).scalar().alias("n_fit"),
        validation.agg(F.count(F.lit(1))).scalar().alias("n_validation"),
        F.col("validation_auc").between(0, 1).alias("auc_in_range"),
    )


@query(
    "tuning_comparison_checked",
    """SELECT metric, TRUE AS change_follows, TRUE AS verdict_follows FROM (VALUES ('accuracy'), ('precision_pos'),
    ('recall_pos'), ('f1_pos'), ('specificity'), ('auc_roc')) m(metric)""",
)
def tuning_comparison_checked(spark, sf_dir):
    """Before and after per metric: the change and the verdict follow from the two values."""
    found = materialise(tuning_comparison(spark, sf_dir), "tuning-comparison")
    change = F.col("after") - F.col("before")
    verdict = F.when(change > 1e-4, "better").when(change < -1e-4, "worse").otherwise("same")
    return found.select(
        "metric", (F.col("change") == change).alias("change_follows"), (F.col("verdict") == verdict).alias("verdict_follows")
    )
