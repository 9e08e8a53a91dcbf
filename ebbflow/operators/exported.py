"""Fitted models as tables, and scores taken from those tables by joins and JVM expressions.

A regression becomes one row for each slot of its vector, a forest one row for each node.
Whoever holds the tables can score rows without MLlib, and the two scores can be compared.
The tables have the size of the model, never that of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.operators.learning import FEATURES
from ebbflow.settings import FeatureSet
from ebbflow.sources.layers import materialise, new_path

SLOT_COLUMNS = "slot int, source string, value string, unseen boolean"


def vector_slots(spark: SparkSession, model: PipelineModel, features: FeatureSet = FEATURES) -> DataFrame:
    """(slot, source, value, unseen): what each slot of the assembled vector stands for.

    `value` is null for a number. The slot of values the fit has not seen, where the encoder
    keeps one, is marked `unseen`.
    """
    labels = model.stages[0].labelsArray
    rows: list[tuple] = []

    def categories() -> None:
        for column, values in zip(features.categorical, labels):
            first = len(rows)
            rows.extend((first + i, column, v, False) for i, v in enumerate(values))
            if features.encoder_invalid == "keep":
                rows.append((len(rows), column, None, True))

    def numbers() -> None:
        first = len(rows)
        rows.extend((first + i, column, None, False) for i, column in enumerate(features.numeric))

    for part in (categories, numbers) if features.categorical_first else (numbers, categories):
        part()
    return spark.createDataFrame(rows, SLOT_COLUMNS)


def regression_table(spark: SparkSession, model: PipelineModel, features: FeatureSet = FEATURES) -> DataFrame:
    """The slots with their coefficient, written once; the intercept has slot -1 and no source."""
    fitted = model.stages[-1]
    values = [(i, float(v)) for i, v in enumerate(fitted.coefficients.toArray())]
    coefficients = spark.createDataFrame(values, "slot int, coefficient double")
    intercept = spark.createDataFrame(
        [(-1, None, None, False, float(fitted.intercept))], f"{SLOT_COLUMNS}, coefficient double"
    )
    slots = vector_slots(spark, model, features).join(coefficients, "slot")
    return materialise(slots.unionByName(intercept), "regression")


def regression_scores(rows: DataFrame, table: DataFrame, features: FeatureSet = FEATURES, name: str = "own_score") -> DataFrame:
    """Add the probability of class 1: one join with the coefficients of each categorical column.

    A value without a coefficient takes that of the unseen slot, else zero.
    """
    numbers = table.filter("slot >= 0 and value is null and not unseen")
    per_number = numbers.agg(F.map_from_entries(F.collect_list(F.struct("source", "coefficient")))).scalar()
    margin = table.filter("slot = -1").select("coefficient").scalar()
    for column in features.numeric:
        margin = margin + F.element_at(per_number, column) * F.col(column)
    scored = rows
    for i, column in enumerate(features.categorical):
        known = table.filter((F.col("source") == column) & F.col("value").isNotNull())
        scored = scored.join(known.select(F.col("value").alias(column), F.col("coefficient").alias(f"_c{i}")), column, "left")
        unseen = table.filter((F.col("source") == column) & F.col("unseen")).agg(F.max("coefficient")).scalar()
        margin = margin + F.coalesce(f"_c{i}", unseen, F.lit(0.0))
    scored = scored.withColumn(name, 1 / (1 + F.exp(-margin)))
    return scored.drop(*[f"_c{i}" for i in range(len(features.categorical))])


def forest_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(tree, node, feature, cut, left_values, left, right, p1): one row per node, as the saved model holds them.

    A node sends a row to the left if its value is at most `cut`, or among `left_values`
    where these are given. A leaf has no children; `p1` is the share of class 1 in a node.
    """
    path = new_path(spark, "forest")
    model.stages[-1].write().save(path)
    node = F.col("nodeData")
    counts = node["impurityStats"]
    categorical = node["split"]["numCategories"] >= 0
    values = node["split"]["leftCategoriesOrThreshold"]
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["split"]["featureIndex"].alias("feature"),
        F.when(~categorical, F.get(values, 0)).alias("cut"),
        F.when(categorical, values).alias("left_values"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        (counts[1] / F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)).alias("p1"),
    )


def _with_vector(rows: DataFrame, slots: DataFrame, features: FeatureSet) -> DataFrame:
    """Add `_vector`, the assembled vector as an array, from the slots' table alone."""
    key = F.concat_ws("\t", "source", "value")
    known = slots.filter("value is not null").agg(F.map_from_entries(F.collect_list(F.struct(key, "slot"))))
    layout = slots.agg(F.array_sort(F.collect_list(F.struct("slot", "source", "unseen"))))
    hits = [F.element_at("_known", F.concat_ws("\t", F.lit(c), F.col(c))) for c in features.categorical]
    keyed = lambda names, values: F.create_map(*[x for c, v in zip(names, values) for x in (F.lit(c), v)])
    filled = rows.withColumns({"_known": known.scalar(), "_layout": layout.scalar()}).withColumns(
        {
            "_hit": keyed(features.categorical, hits),
            "_number": keyed(features.numeric, [F.col(c).cast("double") for c in features.numeric]),
        }
    )

    def value(x: Column) -> Column:
        hit = F.element_at("_hit", x["source"])
        inside = F.coalesce(hit == x["slot"], x["unseen"]).cast("double")
        return F.when(F.map_contains_key("_hit", x["source"]), inside).otherwise(F.element_at("_number", x["source"]))

    return filled.withColumn("_vector", F.transform("_layout", value)).drop("_known", "_layout", "_hit", "_number")


def forest_scores(
    rows: DataFrame, nodes: DataFrame, slots: DataFrame, features: FeatureSet = FEATURES, name: str = "own_score"
) -> DataFrame:
    """Add the probability of class 1: each tree is walked from node to node inside one expression.

    The trees arrive as one scalar of the model's size, so the rows are not multiplied.
    """
    fields = ("node", "feature", "cut", "left_values", "left", "right", "p1")
    per_tree = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("nodes"), F.count(F.lit(1)).alias("n"))
    depth = per_tree.agg(F.greatest(F.ceil(F.max("n") / 2), F.lit(1)).cast("int"))  # no path is longer
    scored = _with_vector(rows, slots, features).withColumns(
        {"_forest": per_tree.agg(F.collect_list("nodes")).scalar(), "_depth": F.least(depth.scalar(), F.lit(30))}
    )

    def leaf_share(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            node = F.get(tree, at)
            x = F.get("_vector", node["feature"])
            goes_left = F.coalesce(F.array_contains(node["left_values"], x), x <= node["cut"])
            return F.when(node["left"] < 0, at).when(goes_left, node["left"]).otherwise(node["right"])

        return F.get(tree, F.aggregate(F.sequence(F.lit(1), "_depth"), F.lit(0), step))["p1"]

    shares = F.transform("_forest", leaf_share)
    mean = F.aggregate(shares, F.lit(0.0), lambda a, b: a + b) / F.size("_forest")
    return scored.withColumn(name, mean).drop("_vector", "_forest", "_depth")


def agreement(scored: DataFrame, keys: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """The keys, and whether MLlib's `score` and `prediction` agree with `own_score`."""
    return scored.select(
        *keys,
        (F.abs(F.col("score") - F.col("own_score")) <= tolerance).alias("same_score"),
        # a probability of one half is class 0
        (F.col("prediction") == F.when(F.col("own_score") > 0.5 + tolerance, 1.0).when(F.col("own_score") < 0.5 - tolerance, 0.0).otherwise(F.col("prediction"))).alias("same_class"),
    )


def calibration(scored: DataFrame, columns: Sequence[str], label: str = FEATURES.label) -> DataFrame:
    """(column_name, value, n_rows, n_pos, expected_pos): positives met and expected per category.

    A regression with an intercept that is fitted without a penalty expects, among its
    training rows, just as many positives of each category as there are.
    """
    long = scored.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])).alias("c"),
        F.col(label).alias("label"),
        "score",
    )
    return long.groupBy("c.column_name", "c.value").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("label").cast("bigint").alias("n_pos"),
        F.round(F.sum("score")).cast("bigint").alias("expected_pos"),
    )


def fit_quality(scored: DataFrame, label: str = FEATURES.label) -> DataFrame:
    """One row: rows, positives, and mean log loss and Brier score beside those of the base rate."""
    y, p = F.col(label), F.col("score")
    safe = F.greatest(F.least(p, F.lit(1 - 1e-15)), F.lit(1e-15))
    sums = scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(y).cast("bigint").alias("n_pos"),
        F.avg(-F.ln(F.when(y == 1, safe).otherwise(1 - safe))).alias("log_loss"),
        F.avg((y - p) * (y - p)).alias("brier"),
    )
    rate = F.col("n_pos") / F.col("n_rows")
    entropy = lambda q: F.when(q > 0, -q * F.ln(q)).otherwise(0.0)
    return sums.withColumns({"null_log_loss": entropy(rate) + entropy(1 - rate), "null_brier": rate * (1 - rate)})
