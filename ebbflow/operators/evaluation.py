"""Judging a binary classifier from rows (label, prediction, score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.functions import guarded_ratio
from ebbflow.operators.profiling import cardinality
from ebbflow.operators.ranking import running_totals

METRICS_COLUMNS = (
    "auc_roc",
    "accuracy",
    "precision_pos",
    "recall_pos",
    "f1_pos",
    "specificity",
)


def confusion_matrix(
    predictions: DataFrame, label: str = "high_turnover", prediction: str = "prediction"
) -> DataFrame:
    """tn, fp, fn, tp in one pass: one row."""

    def cell(actual: int, predicted: int) -> Column:
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted))

    return predictions.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def classification_metrics(confusion: DataFrame) -> DataFrame:
    """Class-1 and weighted rates; a rate with nothing to divide by is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    precision, recall = guarded_ratio(tp, tp + fp), guarded_ratio(tp, tp + fn)
    rates = confusion.select(
        "*",
        guarded_ratio(tp + tn, n).alias("accuracy"),
        precision.alias("precision_pos"),
        recall.alias("recall_pos"),
        guarded_ratio(2 * tp, 2 * tp + fp + fn).alias("f1_pos"),
        guarded_ratio(tn, tn + fp).alias("specificity"),
        (
            guarded_ratio(tp + fn, n) * precision
            + guarded_ratio(tn + fp, n) * guarded_ratio(tn, tn + fn)
        ).alias("weighted_precision"),
        guarded_ratio(tp + tn, n).alias("weighted_recall"),
    )
    return rates


def auc_rank(
    predictions: DataFrame,
    label: str = "high_turnover",
    score: str = "score",
) -> DataFrame:
    """Exact area under the ROC curve from ranks, ties counting half: one row.

    The share of (positive, negative) pairs ranked rightly, found from running totals
    over distinct scores; no pair is ever formed.
    """
    counts = predictions.groupBy(F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = running_totals(counts, [], "_score", ["pos", "neg"])
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max(F.col("pos_all").cast("double") * F.col("neg_all"))
    return ranked.agg(
        F.max("pos_all").alias("n_pos"),
        F.max("neg_all").alias("n_neg"),
        guarded_ratio(won, pairs).alias("auc"),
    )


def majority_class(train: DataFrame, label: str = "high_turnover") -> Column:
    """Most frequent class of the train part, as a scalar; the lower label wins a tie."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.min_by(label, F.struct(-F.col("_n"), F.col(label)))).scalar()


def baseline_predictions(parts: DataFrame, label: str = "high_turnover") -> DataFrame:
    """Test rows predicted as the majority class of the train rows."""
    majority = majority_class(parts.filter(F.col("part") == "train"), label)
    return parts.filter(F.col("part") == "test").withColumn("prediction", majority)


def rule_predictions(parts: DataFrame, cut: float = 0.5, score: str = "share_neg") -> DataFrame:
    """Test rows predicted by today's exit share: no fitted model involved."""
    test = parts.filter(F.col("part") == "test")
    return test.withColumn("score", F.col(score)).withColumn(
        "prediction", F.when(F.col(score) > cut, 1).otherwise(0)
    )


def category_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """The index a frequency-ordered string indexer gives each category.

    Most frequent first, ties in value order. Meant for columns that will be one-hot
    encoded: each category is a vector slot, so a window partition (the counted
    categories of one column) is as small as the feature vector.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        texts.unpivot([], columns, "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("column_name").orderBy(F.col("n").desc(), "value")
    return counts.withColumn("index", F.row_number().over(order) - 1)


def vector_width(
    df: DataFrame, categorical: list[str], numeric: list[str], encoder_invalid: str = "error"
) -> DataFrame:
    """Slots of the feature vector: categories, one spare per column when the encoder
    keeps unknown values, and the numeric columns. One row."""
    spare = len(categorical) if encoder_invalid == "keep" else 0
    return cardinality(df, categorical).agg(
        F.sum("n_distinct").alias("n_category_slots"),
        F.lit(spare).cast("bigint").alias("n_spare_slots"),
        F.lit(len(numeric)).cast("bigint").alias("n_numeric"),
        (F.sum("n_distinct") + spare + len(numeric)).alias("vector_width"),
    )
