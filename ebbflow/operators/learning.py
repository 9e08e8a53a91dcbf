"""Spark MLlib models over silver tables."""

from __future__ import annotations

import itertools
import time
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ebbflow.operators.evaluation import (
    METRICS_COLUMNS,
    auc_rank,
    baseline_predictions,
    classification_metrics,
    confusion_matrix,
)
from ebbflow.operators.quality import require_no_leakage
from ebbflow.operators.splits import hash_part
from ebbflow.settings import REGIONAL, FeatureSet
from ebbflow.sources.layers import materialise, new_path

SEED = 42
FIT_TASKS = 4
COHORT_KEY = ("month_seq", "region", "section", "age_band")
FEATURES = REGIONAL.features


def feature_stages(features: FeatureSet = FEATURES) -> list[Estimator]:
    """Index, one-hot encode and assemble; all columns in one stage each, so the
    category counts of every column come from a single pass."""
    require_no_leakage(features)
    indexed = [f"{c}_idx" for c in features.categorical]
    encoded = [f"{c}_ohe" for c in features.categorical]
    inputs = (
        [*encoded, *features.numeric]
        if features.categorical_first
        else [*features.numeric, *encoded]
    )
    return [
        StringIndexer(inputCols=list(features.categorical), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid=features.encoder_invalid),
        VectorAssembler(inputCols=inputs, outputCol="features"),
    ]


def logistic_regression(features: FeatureSet = FEATURES) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=features.label)


def random_forest(
    features: FeatureSet = FEATURES, trees: int = 30, depth: int = 8, min_instances: int = 1
) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features",
        labelCol=features.label,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_instances,
        seed=SEED,
    )


def stable_layout(
    df: DataFrame, keys: Sequence[str] = COHORT_KEY, tasks: int = FIT_TASKS
) -> DataFrame:
    """Spread rows by key, ordered inside a partition.

    Sampling inside MLlib follows the physical order of rows; with this layout a fit
    repeats whatever the files looked like. It depends on the rows, the keys and the
    number of tasks a caller names, at every size; large training sets want more tasks.
    """
    return df.repartition(tasks, *keys).sortWithinPartitions(*keys)


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep `df` on executors (spilling to disk) while a fit iterates over it."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def split_parts(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        parts.filter(F.col("part") == "train").drop("part"),
        parts.filter(F.col("part") == "test").drop("part"),
    )


def without_summary(spark: SparkSession, model: Model) -> Model:
    """The fitted classifier as it is saved, without the summary of its training rows.

    The summary holds the session, which tasks are sent along with the model, and a session
    in which any rows have been observed (`DataFrame.observe`) cannot be sent.
    """
    path = new_path(spark, "classifier")
    model.write().save(path)
    return type(model).load(path)


def fit(
    train: DataFrame,
    classifier: Estimator,
    features: FeatureSet = FEATURES,
    keys: Sequence[str] = COHORT_KEY,
    tasks: int = FIT_TASKS,
) -> tuple[PipelineModel, float]:
    """The fitted pipeline and how many seconds the fit took."""
    with held(stable_layout(train, keys, tasks)) as layout:
        started = time.perf_counter()
        model = Pipeline(stages=[*feature_stages(features), classifier]).fit(layout)
        seconds = time.perf_counter() - started
    *prepared, fitted = model.stages
    return PipelineModel([*prepared, without_summary(train.sparkSession, fitted)]), seconds


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add `prediction` and `score`, the probability of class 1."""
    scored = model.transform(rows)
    return scored.withColumn("score", vector_to_array("probability")[1])


def scores(
    model: PipelineModel, rows: DataFrame, label: str = FEATURES.label
) -> DataFrame:
    """(label, prediction, score) of every row, written once: the model is applied a
    single time however many metrics are then taken."""
    return materialise(predict(model, rows).select(label, "prediction", "score"), "scores")


def area_under_roc(scored: DataFrame, label: str = FEATURES.label) -> float:
    """MLlib's evaluator (scores binned); `evaluation.auc_rank` is the exact one."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="score", metricName="areaUnderROC"
    )
    return evaluator.evaluate(scored)


def metrics_row(
    scored: DataFrame,
    model: str,
    seconds: float,
    label: str = FEATURES.label,
) -> DataFrame:
    """One comparison row per model from its `scores`, AUC taken exactly from ranks."""
    rates = classification_metrics(confusion_matrix(scored, label))
    auc = auc_rank(scored, label).select("auc").scalar()
    return _comparison_row(rates.withColumn("auc_roc", auc), model, seconds)


def _comparison_row(rates: DataFrame, model: str, seconds: float) -> DataFrame:
    return rates.select(
        F.lit(model).alias("model"),
        *[F.round(c, 6).alias(c) for c in METRICS_COLUMNS],
        "tn",
        "fp",
        "fn",
        "tp",
        F.lit(seconds).alias("training_seconds"),
        F.lit(SEED).alias("seed"),
    )


def baseline_row(parts: DataFrame, label: str = FEATURES.label) -> DataFrame:
    """The majority-class row of the comparison; a constant ranks nothing, AUC 0.5."""
    rates = classification_metrics(confusion_matrix(baseline_predictions(parts, label), label))
    return _comparison_row(rates.withColumn("auc_roc", F.lit(0.5)), "baseline", 0.0)


def recommended(metrics: DataFrame) -> DataFrame:
    """The model with the highest AUC, random forest winning a tie with regression."""
    preference = F.when(F.col("model") == "random_forest", 0).otherwise(1)
    return metrics.orderBy(F.col("auc_roc").desc(), preference, "model").limit(1)


def feature_names(predictions: DataFrame, column: str = "features") -> DataFrame:
    """(slot, name) of the assembled vector, from the column's metadata."""
    attributes = predictions.schema[column].metadata.get("ml_attr", {})
    named = {
        a["idx"]: a.get("name", f"feature_{a['idx']}")
        for group in attributes.get("attrs", {}).values()
        for a in group
    }
    width = attributes.get("num_attrs", max(named, default=-1) + 1)
    rows = [(slot, named.get(slot, f"feature_{slot}")) for slot in range(width)]
    return predictions.sparkSession.createDataFrame(rows, "slot int, name string")


def _per_slot(predictions: DataFrame, values: Sequence[float], name: str) -> DataFrame:
    spark = predictions.sparkSession
    rows = spark.createDataFrame(
        [(i, float(v)) for i, v in enumerate(values)], f"slot int, {name} double"
    )
    return feature_names(predictions).join(rows, "slot")


def slot_source(name: F.Column, features: FeatureSet = FEATURES) -> F.Column:
    """Source column of a vector slot: the longest input name the slot name starts with."""
    source = F.when(name.isin(*features.numeric), name)
    for column in sorted(features.categorical, key=len, reverse=True):
        source = source.when(name.startswith(f"{column}_ohe_"), column)
    return source.otherwise(name)


def feature_importance(
    model: PipelineModel, predictions: DataFrame, features: FeatureSet = FEATURES
) -> DataFrame:
    """(slot, name, source, importance), most important first."""
    values = model.stages[-1].featureImportances.toArray()
    slots = _per_slot(predictions, values, "importance")
    return slots.withColumn("source", slot_source(F.col("name"), features)).orderBy(
        F.col("importance").desc(), "slot"
    )


def source_importance(importance: DataFrame) -> DataFrame:
    """Importance summed over the slots of each source column."""
    return (
        importance.groupBy("source")
        .agg(F.sum("importance").alias("importance"), F.count(F.lit(1)).alias("n_slots"))
        .orderBy(F.col("importance").desc(), "source")
    )


def coefficients(model: PipelineModel, predictions: DataFrame) -> DataFrame:
    """(slot, name, coefficient, sign), largest magnitude first."""
    values = model.stages[-1].coefficients.toArray()
    slots = _per_slot(predictions, values, "coefficient")
    sign = F.when(F.col("coefficient") > 0, "+").otherwise("-")
    return slots.withColumn("sign", sign).orderBy(F.abs("coefficient").desc(), "slot")


CUT_SEED = 43  # not the seed of the outer split, which would leave one side empty


def tuning_cut(
    train: DataFrame, keys: Sequence[str] = COHORT_KEY, fit_percent: int = 70
) -> tuple[DataFrame, DataFrame]:
    """(fit rows, validation rows) of the training part, by a hash of the key.

    A retried task or another layout gives the same cut, and a key is never on both sides.
    """
    cut = hash_part(train, keys, fit_percent, CUT_SEED)
    return split_parts(cut)


def tuning_grid(
    spark: SparkSession,
    trees: Sequence[int] = (20, 30),
    depths: Sequence[int] = (5, 8),
    min_instances: Sequence[int] = (1, 5),
) -> DataFrame:
    """(combination, trees, depth, min_instances): a row for each forest to grow."""
    points = itertools.product(trees, depths, min_instances)
    rows = [(i, *point) for i, point in enumerate(points, 1)]
    return spark.createDataFrame(rows, "combination int, trees int, depth int, min_instances int")


def tune(
    train: DataFrame,
    features: FeatureSet = FEATURES,
    trees: Sequence[int] = (20, 30),
    depths: Sequence[int] = (5, 8),
    min_instances: Sequence[int] = (1, 5),
    fit_percent: int = 70,
    parallelism: int = 4,
    keys: Sequence[str] = COHORT_KEY,
    tasks: int = FIT_TASKS,
) -> tuple[PipelineModel, list[dict], float]:
    """Grid search of the whole pipeline on a cut of the training rows.

    The features are prepared on the fit rows alone, so nothing about the validation rows,
    such as their categories, reaches a fit. Vectors of both sides are held once, so each
    combination costs one forest; `parallelism` forests grow at a time and share the
    executors. The best combination is then fitted, features included, on all of `train`.
    Returns that pipeline, one record per combination and seconds.
    """
    started = time.perf_counter()
    fit_rows, validation = tuning_cut(train, keys, fit_percent)
    prepared = Pipeline(stages=feature_stages(features)).fit(fit_rows)
    columns = ("features", features.label)
    layout = stable_layout(prepared.transform(fit_rows), keys, tasks).select(*columns)
    points = [p.asDict() for p in tuning_grid(train.sparkSession, trees, depths, min_instances).collect()]
    with held(layout) as fit_vectors, held(prepared.transform(validation).select(*columns)) as judged:

        def validation_auc(point: dict) -> float:
            grown = random_forest(features, point["trees"], point["depth"], point["min_instances"]).fit(fit_vectors)
            grown = without_summary(train.sparkSession, grown)
            scored = grown.transform(judged).select(features.label, vector_to_array("probability")[1].alias("score"))
            return area_under_roc(scored, features.label)

        with ThreadPoolExecutor(parallelism) as pool:
            aucs = list(pool.map(validation_auc, points))
    records = [{**point, "validation_auc": auc} for point, auc in zip(points, aucs)]
    won = max(records, key=lambda r: (r["validation_auc"], -r["combination"]))
    forest = random_forest(features, won["trees"], won["depth"], won["min_instances"])
    best, _ = fit(train, forest, features, keys, tasks)
    return best, records, time.perf_counter() - started


def tuning_grid_report(records: list[dict], predictions: DataFrame) -> DataFrame:
    """One row per combination, best validation AUC first."""
    rows = [
        (r["combination"], r["trees"], r["depth"], r["min_instances"], float(r["validation_auc"]))
        for r in records
    ]
    schema = "combination int, trees int, depth int, min_instances int, validation_auc double"
    frame = predictions.sparkSession.createDataFrame(rows, schema)
    return frame.orderBy(F.col("validation_auc").desc(), "combination")


def tuning_comparison(base: DataFrame, tuned: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Before/after per metric from two metrics rows, with the cost and a verdict.

    `better` and `worse` need a change larger than `tolerance`; smaller ones are noise
    of the partitioning.
    """
    measures = list(METRICS_COLUMNS)
    before = base.unpivot(["training_seconds"], measures, "metric", "before")
    after = tuned.unpivot(["training_seconds"], measures, "metric", "after")
    joined = before.withColumnRenamed("training_seconds", "_base").join(
        after.withColumnRenamed("training_seconds", "_tuned"), "metric"
    )
    change = F.col("after") - F.col("before")
    verdict = (
        F.when(change > tolerance, "better").when(change < -tolerance, "worse").otherwise("same")
    )
    return joined.select(
        "metric",
        "before",
        "after",
        change.alias("change"),
        verdict.alias("verdict"),
        F.when(F.col("_base") > 0, F.col("_tuned") / F.col("_base")).alias("cost_factor"),
    )


def worth_tuning(comparison: DataFrame) -> DataFrame:
    """One row: whether AUC or F1 got better by more than the tolerance."""
    gained = F.count_if(
        F.col("metric").isin("auc_roc", "f1_pos") & (F.col("verdict") == "better")
    )
    return comparison.agg((gained > 0).alias("worth_it"), F.max("cost_factor").alias("cost_factor"))


def save_model(model: PipelineModel, path: str) -> PipelineModel:
    """Overwrite, then load what was written, so a broken write is noticed at once."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
