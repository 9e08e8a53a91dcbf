from __future__ import annotations

import math
import random
from functools import reduce

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ebbflow.operators import evaluation as ev
from ebbflow.operators import exported as ex
from ebbflow.operators import learning as le
from ebbflow.plans.stages import parts_stage
from ebbflow.settings import NATIONAL, REGIONAL, FeatureSet


@pytest.fixture(scope="module")
def parts(spark, small):
    return parts_stage(spark, small)


@pytest.fixture(scope="module")
def forest(parts):
    train, test = le.split_parts(parts.table)
    model, seconds = le.fit(train, le.random_forest(trees=5, depth=4))
    return model, le.predict(model, test).cache(), seconds


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "high_turnover int, prediction int")
    row = ev.classification_metrics(ev.confusion_matrix(df)).first()
    assert (row.precision_pos, row.recall_pos, row.f1_pos, row.specificity) == (0.0, 0.0, 0.0, 1.0)
    assert row.accuracy == pytest.approx(2 / 3)


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [3, 1000])
def test_auc_matches_pairs_and_evaluator(spark, levels):
    rng = random.Random(levels)
    pairs = [(rng.randint(0, 1), rng.randint(0, levels) / levels) for _ in range(300)]
    df = spark.createDataFrame(pairs, "high_turnover int, score double")
    expected = brute_auc(pairs)
    for rows in (None, 300):
        assert ev.auc_rank(df).first().auc == pytest.approx(expected, abs=1e-12)
    evaluator = BinaryClassificationEvaluator(labelCol="high_turnover", rawPredictionCol="score")
    assert evaluator.evaluate(df) == pytest.approx(expected, abs=0.01)


def test_majority_tie_goes_to_the_lower_label(spark):
    df = spark.createDataFrame([(0,), (1,)], "high_turnover int")
    assert df.select(ev.majority_class(df)).first()[0] == 0
    more = spark.createDataFrame([(0,), (1,), (1,)], "high_turnover int")
    assert more.select(ev.majority_class(more)).first()[0] == 1


def test_category_index_is_the_string_indexer_order(parts, spark):
    from pyspark.ml.feature import StringIndexer

    columns = list(le.FEATURES.categorical)
    model = StringIndexer(inputCols=columns, outputCols=[f"{c}_i" for c in columns]).fit(parts.table)
    ours = ev.category_index(parts.table, columns).collect()
    for column, labels in zip(columns, model.labelsArray):
        mine = sorted((r["index"], r.value) for r in ours if r.column_name == column)
        assert [v for _, v in mine] == list(labels)


@pytest.mark.parametrize("features", [le.FEATURES, NATIONAL.features], ids=["regional", "national"])
def test_vector_width_matches_the_assembled_vector(spark, small, features):
    study = NATIONAL if features is NATIONAL.features else REGIONAL
    rows = parts_stage(spark, small, study).table
    vectors = Pipeline(stages=le.feature_stages(features)).fit(rows).transform(rows)
    width = ev.vector_width(
        rows, list(features.categorical), list(features.numeric), features.encoder_invalid
    ).first()
    assert len(vectors.select("features").first().features) == width.vector_width
    names = le.feature_names(vectors)
    assert names.count() == width.vector_width
    first = names.filter("slot = 0").first().name
    assert first.startswith("region_ohe_") if features.categorical_first else first == "n_total"


def test_importance_by_source_adds_up(forest):
    model, predictions, seconds = forest
    slots = le.feature_importance(model, predictions)
    sources = le.source_importance(slots).collect()
    assert {r.source for r in sources} == set(le.FEATURES.columns)
    assert sum(r.importance for r in sources) == pytest.approx(1.0)
    assert seconds > 0


def test_source_of_a_slot_is_the_longest_prefix(spark):
    names = ["region_ohe_21", "age_band_ohe_65+", "volume_band_ohe_MEDIO", "n_total", "year"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.s for r in df.select(le.slot_source(F.col("name")).alias("s")).collect()]
    assert got == ["region", "age_band", "volume_band", "n_total", "year"]


def test_metrics_row_and_recommendation(forest, parts):
    _, predictions, seconds = forest
    row = le.metrics_row(predictions, "random_forest", seconds)
    both = le.baseline_row(parts.table).unionByName(row)
    values = {r.model: r for r in both.collect()}
    exact = values["random_forest"].auc_roc
    assert exact == pytest.approx(le.area_under_roc(predictions), abs=0.01)
    assert values["baseline"].auc_roc == 0.5
    best = "random_forest" if exact > 0.5 else "baseline"
    assert le.recommended(both).first().model == best


def test_models_score_in_a_session_that_has_observed_rows(spark, parts):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    train, test = le.split_parts(parts.table)
    for classifier in (le.logistic_regression().setMaxIter(2), le.random_forest(trees=2, depth=2)):
        model, _ = le.fit(train, classifier)
        assert le.predict(model, test).filter("score between 0 and 1").count() == test.count()
    _, records, _ = le.tune(train, trees=(2,), depths=(2,), min_instances=(1,))
    assert 0 <= records[0]["validation_auc"] <= 1


def test_fit_repeats_whatever_the_layout(parts):
    train, test = le.split_parts(parts.table)
    a, _ = le.fit(train, le.random_forest(trees=3, depth=3))
    shuffled = train.repartition(7, F.rand(1))
    b, _ = le.fit(shuffled, le.random_forest(trees=3, depth=3))
    keys = list(le.COHORT_KEY)
    left = le.predict(a, test).select(*keys, F.col("score").alias("s1"))
    right = le.predict(b, test).select(*keys, F.col("score").alias("s2"))
    assert left.join(right, keys).filter("abs(s1 - s2) > 1e-9").isEmpty()


def test_save_and_load(forest, parts, tmp_path):
    model, predictions, _ = forest
    loaded = le.save_model(model, str(tmp_path / "m"))
    _, test = le.split_parts(parts.table)
    again = le.predict(loaded, test)
    assert again.select("score").exceptAll(predictions.select("score")).isEmpty()


def test_regression_coefficients(parts):
    train, test = le.split_parts(parts.table)
    model, _ = le.fit(train, le.logistic_regression())
    rows = le.coefficients(model, le.predict(model, test)).collect()
    magnitudes = [abs(r.coefficient) for r in rows]
    assert magnitudes == sorted(magnitudes, reverse=True)
    assert all((r.sign == "+") == (r.coefficient > 0) for r in rows)


def test_tuning(parts):
    train, test = le.split_parts(parts.table)
    best, records, seconds = le.tune(
        train, trees=(2, 3), depths=(2,), min_instances=(1,)
    )
    assert [r["trees"] for r in records] == [2, 3]
    report = le.tuning_grid_report(records, le.predict(best, test)).collect()
    assert report[0].validation_auc == max(r["validation_auc"] for r in records)
    row = le.metrics_row(le.predict(best, test), "tuned", seconds)
    same = le.tuning_comparison(row, row)
    assert {r.verdict for r in same.collect()} == {"same"}
    verdict = le.worth_tuning(same).first()
    assert (verdict.worth_it, verdict.cost_factor) == (False, 1.0)


# --- exported models ---------------------------------------------------------------------


def test_regression_scores_by_hand(spark):
    table = spark.createDataFrame(
        [(-1, None, None, False, 0.5), (0, "c", "a", False, 1.0), (1, "c", "b", False, -2.0), (2, "c", None, True, 9.0), (3, "x", None, False, 0.25)],
        "slot int, source string, value string, unseen boolean, coefficient double",
    )
    features = FeatureSet(categorical=("c",), numeric=("x",))
    rows = spark.createDataFrame([("a", 2.0), ("b", 0.0), ("new", 1.0)], "c string, x double")
    got = {r.c: r.own_score for r in ex.regression_scores(rows, table, features).collect()}
    want = {"a": 0.5 + 1 + 0.5, "b": 0.5 - 2, "new": 0.5 + 9 + 0.25}
    assert got == pytest.approx({c: 1 / (1 + math.exp(-m)) for c, m in want.items()})


def test_forest_scores_by_hand(spark):
    slots = spark.createDataFrame(
        [(0, "c", "a", False), (1, "c", "b", False), (2, "x", None, False)], "slot int, source string, value string, unseen boolean"
    )
    # tree 0 asks whether c is b, then x; tree 1 is a single leaf
    nodes = spark.createDataFrame(
        [
            (0, 0, 1, None, [0.0], 1, 2, 0.5), (0, 1, 2, 1.5, None, 3, 4, 0.4), (0, 2, -1, None, None, -1, -1, 0.9),
            (0, 3, -1, None, None, -1, -1, 0.1), (0, 4, -1, None, None, -1, -1, 0.6), (1, 0, -1, None, None, -1, -1, 0.2),
        ],
        "tree int, node int, feature int, cut double, left_values array<double>, left int, right int, p1 double",
    )
    features = FeatureSet(categorical=("c",), numeric=("x",))
    rows = spark.createDataFrame([("a", 1.5), ("a", 1.6), ("b", 0.0), ("new", 0.0)], "c string, x double")
    got = [r.own_score for r in ex.forest_scores(rows, nodes, slots, features).collect()]
    assert got == pytest.approx([(0.1 + 0.2) / 2, (0.6 + 0.2) / 2, (0.9 + 0.2) / 2, (0.1 + 0.2) / 2])


@pytest.mark.parametrize("study", [REGIONAL, NATIONAL], ids=["regional", "national"])
def test_exported_models_score_like_mllib(spark, small, study):
    features = study.features
    train, test = le.split_parts(parts_stage(spark, small, study).table)
    # a category that the fit has not seen
    test = test.withColumn("section", F.when(F.col("region") == test.select(F.min("region")).scalar(), "unseen").otherwise(F.col("section")))
    for classifier in (le.logistic_regression(features), le.random_forest(features, 4, 5)):
        model, _ = le.fit(train, classifier, features)
        scored = le.predict(model, test)
        if hasattr(model.stages[-1], "coefficients"):
            own = ex.regression_scores(scored, ex.regression_table(spark, model, features), features)
        else:
            own = ex.forest_scores(scored, ex.forest_table(spark, model), ex.vector_slots(spark, model, features), features)
        found = ex.agreement(own, study.keys.columns)
        assert found.count() == test.count() and found.filter("not (same_score and same_class)").isEmpty()


def test_slots_are_those_of_the_metadata(spark, parts):
    train, test = le.split_parts(parts.table)
    model, _ = le.fit(train, le.logistic_regression())
    ours = {r.slot: f"{r.source}_ohe_{r.value}" if r.value else r.source for r in ex.vector_slots(spark, model).collect()}
    assert ours == {r.slot: r["name"] for r in le.feature_names(le.predict(model, test)).collect()}


def test_validation_rows_stay_unseen_while_tuning(parts, monkeypatch):
    train, _ = le.split_parts(parts.table)
    fit_rows, validation = le.tuning_cut(train)
    keys = list(le.COHORT_KEY)
    assert fit_rows.join(validation, keys).isEmpty()
    assert fit_rows.count() + validation.count() == train.count()
    key = validation.select(*keys).first()
    mine = reduce(lambda a, b: a & b, [F.col(k) == key[k] for k in keys])
    # one validation row has a section of its own
    marked = train.withColumn("volume_band", F.when(mine, "ONLY_HERE").otherwise(F.col("volume_band")))
    seen = []
    plain = le.feature_stages

    def watched(features=le.FEATURES):
        stages = plain(features)
        fit = stages[0].fit
        monkeypatch.setattr(stages[0], "_fit", lambda rows: seen.append(type(stages[0])._fit(stages[0], rows)) or seen[-1])
        assert fit
        return stages

    monkeypatch.setattr(le, "feature_stages", watched)
    _, records, _ = le.tune(marked, trees=(2,), depths=(2, 3), min_instances=(1,))
    labels = [{v for column in m.labelsArray for v in column} for m in seen]
    assert "ONLY_HERE" not in labels[0] and "ONLY_HERE" in labels[-1]
    assert [r["combination"] for r in records] == [1, 2]
