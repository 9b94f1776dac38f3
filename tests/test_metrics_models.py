import json
import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cohortflow.operators import folds, metrics, models
from cohortflow.plans import lifecycle, medallion, selection
from cohortflow.operators.features import features_of, fit_features
from cohortflow.sources.models import save_model
from cohortflow.sources.tables import read_table


@pytest.fixture(scope="module")
def separable(spark):
    data = [(i, Vectors.dense(float(i % 3) * 4 + (i % 7) / 10, float(i % 5) / 5), float(i % 3)) for i in range(120)]
    return spark.createDataFrame(data, ["id", "features", "label"]).cache()


def test_metrics_equal_the_evaluator(spark):
    df = spark.range(400).select((F.col("id") % 4).cast("double").alias("label"),
                                 (F.col("id") * 7 % 5 % 4).cast("double").alias("prediction"))
    ours = metrics.weighted_metrics(df).first()
    for name, theirs in (("f1_score", "f1"), ("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall")):
        assert math.isclose(ours[name], MulticlassClassificationEvaluator(metricName=theirs).evaluate(df), abs_tol=1e-12)


def test_a_class_that_is_never_predicted_counts_zero(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (2.0, 1.0)], "label double, prediction double")
    row = metrics.weighted_metrics(df).first()
    assert math.isclose(row["f1_score"], 0.5 / 3) and math.isclose(row["accuracy"], 1 / 3)


def test_comparisons(spark, rows):
    scores = spark.createDataFrame([("a", 0.5), ("b", 0.9), ("c", 0.9)], "params string, f1_score double")
    assert tuple(metrics.best_configuration(scores, "params").first()) == ("b", 0.9)
    assert [r["params"] for r in metrics.leaderboard(scores, ties=["params"]).collect()] == ["b", "c", "a"]
    assert {r["params"]: r["retrain"] for r in metrics.quality_watch(scores, floor=0.6).collect()} == {
        "a": True, "b": False, "c": False}
    log = spark.createDataFrame([("m", 2), ("m", 10), ("n", 1)], "name string, version int")
    assert rows(metrics.latest_version(log)) == [("m", 10), ("n", 1)]
    assert metrics.latest_version(log, "m").first()["version"] == 10
    runs = spark.createDataFrame([("p", "FINISHED", 0.1), ("p", "FAILED", 0.9), ("p", "FINISHED", 0.3), ("q", "FINISHED", 1.0)],
                                 "parent string, status string, f1_score double")
    assert [r["f1_score"] for r in metrics.finished_runs(runs, "p", "f1_score").collect()] == [0.3, 0.1]


def test_share_shift_with_new_and_vanished_classes(spark):
    old = spark.createDataFrame([("a",)] * 3 + [("b",)], "prediction string")
    new = spark.createDataFrame([("a",), ("c",)], "prediction string")
    got = {r["class"]: (r["shift"], r["drifted"]) for r in metrics.share_shift(old, new, limit=0.3).collect()}
    assert got == {"a": (-0.25, False), "b": (-0.25, False), "c": (0.5, True)}


def test_points():
    assert len(models.grid_points(models.FOREST_GRID)) == 27 and len(models.grid_points(models.LOGISTIC_GRID)) == 6
    points = models.random_points(models.FOREST_RANGES, 20, seed=1)
    assert points == models.random_points(models.FOREST_RANGES, 20, seed=1) != models.random_points(models.FOREST_RANGES, 20, seed=2)
    assert all(10 <= p["numTrees"] <= 500 and 1 <= p["minInstancesPerNode"] <= 20 and p["maxBins"] % 16 == 0 for p in points)
    assert all(0.05 <= p["stepSize"] <= 0.25 and p["maxDepth"] % 2 == 0 for p in models.random_points(models.BOOSTED_RANGES, 9))


@pytest.mark.parametrize("kind,grid", [
    ("logistic", {"maxIter": [20], "regParam": [0.001, 0.1]}), ("tree", {"maxDepth": [2, 3]}),
    ("forest", {"numTrees": [5], "maxDepth": [3]}), ("boosted", {"maxIter": [2], "maxDepth": [2]}),
    ("support_vector", {"maxIter": [10], "regParam": [0.01]})])
def test_every_kind_beats_the_majority_class(separable, kind, grid):
    outcome = models.cross_validate(kind, separable, grid, folds=2)
    assert outcome.resubstitution["accuracy"] > 0.6
    assert len(outcome.fold_f1) == len(models.grid_points(grid)) and outcome.best_params in models.grid_points(grid)
    assert separable.is_cached  # the caller's cache is left alone
    tried = {r["params"]: r["f1_score"] for r in models.point_frame(separable.sparkSession, [outcome]).collect()}
    assert max(tried.values()) == outcome.best_f1 == tried[json.dumps(outcome.best_params)]


def test_perceptron_width_comes_from_the_data(separable):
    grid = models.perceptron_grid(separable, 3, hidden=[[4]], maxIter=[30], blockSize=[64])
    assert grid["layers"] == [[2, 4, 3]]
    assert models.cross_validate("perceptron", separable, grid, folds=2).resubstitution["accuracy"] > 0.4


def test_search_over_stratified_folds_is_repeatable(spark, separable):
    df = folds.stratified_folds(separable, "label", "id")
    points = [{"maxDepth": 1}, {"maxDepth": 3}]
    first, second = (models.search_points("tree", df, points, fold_column="fold") for _ in range(2))
    assert first.fold_f1 == second.fold_f1 and first.best_params == {"maxDepth": 3}
    frame = models.fold_score_frame(spark, first)
    means = {r["params"]: r["f1_score"] for r in metrics.fold_means(frame, ["params"]).collect()}
    assert math.isclose(means['{"maxDepth": 3}'], first.best_f1)
    result = models.result_frame(spark, [first]).first()
    assert result["best_parameters"] == '{"maxDepth": 3}' and result["model"] == "tree"


def test_life_cycle(spark, small_silver, tmp_path):
    inputs = medallion.feature_input(small_silver)
    stages = fit_features(inputs)
    save_model(stages, str(tmp_path / "stages"))
    df = selection.training_frame(features_of(inputs, stages, ["id"]), medallion.gold_target(small_silver))
    log, folder = str(tmp_path / "log"), str(tmp_path / "models")
    outcomes = selection.compare_models(df, df, {"scaled": [("logistic", {"maxIter": [5]})], "plain": [("tree", {"maxDepth": [3]})]},
                                        folds=2)
    best = lifecycle.register_best(spark, outcomes, log, folder, "m")
    assert best.best_f1 == max(o.best_f1 for o in outcomes)
    assert lifecycle.retrain(spark, df, log, folder, "m") == 2
    assert lifecycle.current_version(spark, log, "m")["version"] == 2
    assert metrics.latest_version(read_table(spark, log), "m").first()["version"] == 2
    out = lifecycle.predict(spark, inputs, str(tmp_path / "stages"), log, "m")
    assert out.count() == inputs.count() and {r["prediction"] for r in out.collect()} <= {0.0, 1.0, 2.0, 3.0}
    with pytest.raises(ValueError):
        lifecycle.retrain(spark, df, log, folder, "unknown")


def test_boosted_model_is_saved_and_loaded(spark, separable, tmp_path):
    outcome = models.cross_validate("boosted", separable, {"maxIter": [1], "maxDepth": [2]}, folds=2)
    lifecycle.register_best(spark, [outcome], str(tmp_path / "log"), str(tmp_path / "models"), "b")
    model = lifecycle.current_model(spark, str(tmp_path / "log"), "b")
    assert model.transform(separable).count() == 120


def test_duplicate_ids_multiply_as_in_any_inner_join(spark):
    features = spark.createDataFrame([(1, Vectors.dense(1.0)), (1, Vectors.dense(2.0))], ["id", "features"])
    target = spark.createDataFrame([(1, 4), (1, 2), (2, 1)], "id long, segmentation int")
    out = selection.training_frame(features, target)
    assert sorted(r["label"] for r in out.collect()) == [1.0, 1.0, 3.0, 3.0]


@pytest.mark.parametrize("kind, settings", [("support_vector", {"maxIter": 2}), ("logistic", {"maxIter": 2}), ("forest", {"numTrees": 2}),
                                            ("kernel_support_vector", {"size": 8, "maxIter": 2})])
def test_models_apply_in_a_session_that_has_observed(spark, kind, settings):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    df = spark.createDataFrame([(i, Vectors.dense(float(i % 2), float(i % 5)), float(i % 2)) for i in range(20)], ["id", "features", "label"])
    model = models.classifier(kind, settings).fit(df)
    assert len(model.transform(df).select("prediction").collect()) == 20


def test_a_kept_frame_of_one_partition_is_dealt_over_the_cores(spark, separable):
    one = spark.createDataFrame(separable.rdd, separable.schema).coalesce(1)
    with models.kept(one) as df:
        assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        assert max(len(p) for p in df.rdd.glom().collect()) < 60 and df.count() == 120


def test_retraining_reads_its_rows_once(spark, tmp_path, separable):
    log, folder = str(tmp_path / "log"), str(tmp_path / "models")
    outcome = models.cross_validate("tree", separable, {"maxDepth": [2]}, folds=2)
    lifecycle.register_best(spark, [outcome], log, folder, "m")
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame(separable.rdd, separable.schema).withColumn("_n", F.lit(1))
    counted = rows.select("id", "label", "features").join(rows.select("id").mapInArrow(seen, "id long"), "id")
    assert lifecycle.retrain(spark, counted, log, folder, "m") == 2 and read.value == 120
