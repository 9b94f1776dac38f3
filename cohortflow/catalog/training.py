"""Queries that fit, compare, save and apply classifiers. Grids are small; the data are whole tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import config
from cohortflow.catalog.base import RULE_SQL, Query, feature_input, profile, silver, table, with_ctes
from cohortflow.catalog.features import FOLD_SQL, _features_query, _levels_ctes, _vector_sql, gold_features, rounded
from cohortflow.functions import columns as C
from cohortflow.operators import features, folds, models
from cohortflow.operators.boosting import SoftmaxBooster
from cohortflow.plans import lifecycle, medallion, selection
from cohortflow.session import scratch_path, settle
from cohortflow.sources.models import save_model
from cohortflow.sources.tables import append_rows, read_table, write_table


def training(spark: SparkSession, sf_dir: str, scale: bool = False) -> DataFrame:
    target = medallion.gold_target(silver(spark, sf_dir))
    return selection.training_frame(gold_features(spark, sf_dir, scale), target)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready-made vectors with ten classes."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.col("label").cast("double").alias("label"))


def loaded_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold tables written, read back, labelled and joined, in long form."""
    places = {name: scratch_path(spark, name) for name in ("scaled", "plain", "target")}
    write_table(gold_features(spark, sf_dir, True), places["scaled"])
    write_table(gold_features(spark, sf_dir, False), places["plain"])
    write_table(medallion.gold_target(silver(spark, sf_dir)), places["target"])
    scaled, plain = selection.load_training_frames(spark, places["scaled"], places["plain"], places["target"])
    parts = [C.vector_to_rows(df.select("id", "label", F.lit(v).alias("variant"), "features"))
             for v, df in (("scaled", scaled), ("plain", plain))]
    return parts[0].union(parts[1])


def validated(kind: str, grid: dict, scale: bool = False, num_folds: int = 2):
    """A cross-validated grid on the profile features, as a result row."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return models.result_frame(spark, [models.cross_validate(kind, training(spark, sf_dir, scale), grid, folds=num_folds)])
    return run


def grid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold means of every grid point."""
    outcome = models.cross_validate("logistic", training(spark, sf_dir, True), {"maxIter": [10], "regParam": [0.001, 0.1]})
    return models.point_frame(spark, [outcome])


def perceptron(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = training(spark, sf_dir, True)
    grid = models.perceptron_grid(df, 4, hidden=[[8]], maxIter=[10], blockSize=[128])
    return models.result_frame(spark, [models.cross_validate("perceptron", df, grid, folds=2)])


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates on scaled and on unscaled features, one result row each."""
    outcomes = selection.compare_models(
        training(spark, sf_dir, True), training(spark, sf_dir, False),
        {"scaled": [("logistic", {"maxIter": [10], "regParam": [0.01]})],
         "plain": [("tree", {"maxDepth": [3, 5]})]}, folds=2)
    return models.result_frame(spark, outcomes)


def appended_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows, rounded and appended to a results table twice."""
    rows = C.round_doubles(compared(spark, sf_dir))
    target = scratch_path(spark, "results")
    append_rows(rows, target)
    append_rows(rows, target)
    return read_table(spark, target).orderBy(F.desc("f1_score"), "model")


def forest_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest per stratified fold and the weighted F1 of each."""
    df = folds.stratified_folds(training(spark, sf_dir), "label", "id")
    outcome = models.search_points("forest", df, [{"numTrees": 5, "maxDepth": 4}], fold_column="fold")
    return models.fold_score_frame(spark, outcome)


def randomly_searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = folds.stratified_folds(training(spark, sf_dir), "label", "id", folds=2)
    space = {"numTrees": ("quniform", 2, 8, 2), "maxDepth": ("quniform", 2, 5, 1), "minInstancesPerNode": [1, 5, 10]}
    outcome = models.random_search("forest", df, space, 3, folds=2, fold_column="fold")
    return models.result_frame(spark, [outcome])


def majority(spark: SparkSession, sf_dir: str) -> models.Outcome:
    """A tree without a split answers with the most frequent label, so that SQL can follow every number of its training."""
    df = folds.stratified_folds(training(spark, sf_dir), "label", "id")
    return models.cross_validate("tree", df, {"maxDepth": [0]}, fold_column="fold")


def majority_log(spark: SparkSession, sf_dir: str) -> str:
    log, folder = scratch_path(spark, "model-log"), scratch_path(spark, "models")
    lifecycle.register_best(spark, [majority(spark, sf_dir)], log, folder, "segments")
    lifecycle.retrain(spark, training(spark, sf_dir), log, folder, "segments")
    return log


def majority_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = scratch_path(spark, "feature-stages")
    save_model(features.fit_features(feature_input(spark, sf_dir)), stages)
    fresh = medallion.silver(profile(spark, sf_dir).drop("segmentation"), config.SCORING_RULES)
    return lifecycle.predict(spark, medallion.feature_input(fresh), stages, majority_log(spark, sf_dir), "segments")


def logged(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    log, folder = scratch_path(spark, "model-log"), scratch_path(spark, "models")
    outcome = models.cross_validate("tree", training(spark, sf_dir), {"maxDepth": [3, 5]}, folds=2)
    lifecycle.register_best(spark, [outcome], log, folder, "segments")
    return log, folder


def best_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, _ = logged(spark, sf_dir)
    return read_table(spark, log).drop("path")


def retrained(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, folder = logged(spark, sf_dir)
    lifecycle.retrain(spark, training(spark, sf_dir), log, folder, "segments")
    return read_table(spark, log).drop("path")


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments for the label-free profiles that pass the scoring rules."""
    log, _ = logged(spark, sf_dir)
    stages = scratch_path(spark, "feature-stages")
    save_model(features.fit_features(feature_input(spark, sf_dir)), stages)
    fresh = medallion.silver(profile(spark, sf_dir).drop("segmentation"), config.SCORING_RULES)
    return lifecycle.predict(spark, medallion.feature_input(fresh), stages, log, "segments")


# Five yes-or-no features and the label, as Spark and as SQL text.
FLAG_TEXTS = ["coalesce(gender = 'Male', FALSE)", "coalesce(ever_married = 'Yes', FALSE)", "coalesce(graduated = 'Yes', FALSE)",
              "coalesce(age > 40, FALSE)", "coalesce(family_size > 4, FALSE)"]


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver(spark, sf_dir)
    flags = array_to_vector(F.array(*[F.expr(f"CAST(CAST({text} AS INT) AS DOUBLE)") for text in FLAG_TEXTS]))
    return rows.select("id", flags.alias("features"), (C.mapped("segmentation", config.TARGET_MAP, config.TARGET_DEFAULT) - 1).cast("double").alias("label"))


def one_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round of one split each: every class's feature and leaf values, and the mean log-loss before and after it."""
    model = SoftmaxBooster(maxIter=1, maxDepth=1, stepSize=1.0, penalty=1.0).fit(flagged(spark, sf_dir))
    rows = [(c, t.feature[0], *([t.value[t.left[0]], t.value[t.left[0] + 1]] if t.feature[0] >= 0 else [t.value[0]] * 2), model.losses[0][0], model.losses[1][0])
            for c, t in enumerate(model.trees[0])]
    return rounded(spark.createDataFrame(rows, "class int, feature int, left_value double, right_value double, loss_before double, loss_after double"))


def boosted_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of one leaf leave every row at the classes' shares. The scored rows are written, as by a batch job."""
    df = flagged(spark, sf_dir)
    scored = settle(SoftmaxBooster(maxIter=3, maxDepth=0).fit(df).transform(df).select("id", "probability", "prediction"), "scored")
    named = F.posexplode("probability").alias("class", "probability")
    return rounded(scored.select("prediction", named).groupBy("class", "probability", "prediction").agg(F.count(F.lit(1)).alias("rows")))


_flags = ", ".join(f"CAST({text} AS INT) AS f{i}" for i, text in enumerate(FLAG_TEXTS))
_listed = ", ".join(f"f{i}" for i in range(len(FLAG_TEXTS)))
_boosting_ctes = {
    "flags": f"SELECT s.id, CAST(t.segmentation - 1 AS INT) AS label, {_flags} FROM silver s JOIN target t ON t.id = s.id",
    "priors": "SELECT label AS class, count(*) / CAST((SELECT count(*) FROM flags) AS DOUBLE) AS p FROM flags GROUP BY 1",
}
_one_split_sql = with_ctes(
    "target", "SELECT class, feature, round(lv, 6) AS left_value, round(rv, 6) AS right_value, "
    "round((SELECT avg(-ln(p)) FROM flags JOIN priors ON class = label), 6) AS loss_before, "
    "round((SELECT avg(ln(total) - own) FROM losses), 6) AS loss_after FROM best", **_boosting_ctes,
    cells=f"SELECT id, label, unnest([{_listed}]) AS v, unnest(range({len(FLAG_TEXTS)})) AS feature FROM flags",
    sides="SELECT class, p, feature, v, count(*) * p - count(*) FILTER (WHERE label = class) AS g, count(*) * p * (1 - p) AS h FROM cells, priors GROUP BY class, p, feature, v",
    gains="SELECT l.class, l.p, l.feature, -l.g / (l.h + 1) AS lv, -r.g / (r.h + 1) AS rv, "
          "(l.g * l.g / (l.h + 1) + r.g * r.g / (r.h + 1) - (l.g + r.g) * (l.g + r.g) / (l.h + r.h + 1)) / 2 AS gain "
          "FROM sides l JOIN sides r ON l.class = r.class AND l.feature = r.feature AND l.v = 0 AND r.v = 1",
    best="SELECT class, p, CAST(feature AS INT) AS feature, lv, rv FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY gain DESC, feature) AS k FROM gains) WHERE k = 1",
    scores="SELECT c.id, c.label, b.class, ln(b.p) + CASE WHEN c.v = 0 THEN b.lv ELSE b.rv END AS score FROM cells c JOIN best b ON b.feature = c.feature",
    losses="SELECT id, sum(exp(score)) AS total, sum(CASE WHEN class = label THEN score ELSE 0 END) AS own FROM scores GROUP BY id")
_priors_sql = with_ctes(
    "target", "SELECT CAST(class AS INT) AS class, round(p, 6) AS probability, CAST((SELECT arg_max(class, p * 1000 - class * 1e-9) FROM priors) AS DOUBLE) AS prediction, "
    "(SELECT count(*) FROM flags) AS rows FROM priors", **_boosting_ctes)

_labelled_sql = with_ctes(
    "target", "SELECT v.id, CAST(t.segmentation - 1 AS DOUBLE) AS label, v.variant, v.pos, v.value FROM vectors v "
    "JOIN target t ON t.id = v.id", **_levels_ctes(),
    vectors=f"SELECT *, 'plain' AS variant FROM ({_vector_sql(False)}) UNION ALL "
            f"SELECT *, 'scaled' AS variant FROM ({_vector_sql(True)})")

# The most frequent label of the rows a model is fitted on (ties: the smaller label), and its metrics on the rows it judges:
# one label predicted, so its precision is the accuracy and the other labels add nothing.
_majority_metrics = ("round({0}, 6) AS accuracy, round({0}, 6) AS weighted_recall, round({1}, 6) AS weighted_precision, "
                     "round({2}, 6) AS f1_score")
_all_rows = _majority_metrics.format("a", "a * a", "2 * a * a / (a + 1)")
_by_fold = _majority_metrics.format("avg(a)", "avg(a * a)", "avg(2 * a * a / (a + 1))")


def _majority_sql(body: str, **extra: str) -> str:
    return with_ctes(
        "target", body, labelled=f"SELECT id, CAST(segmentation - 1 AS DOUBLE) AS label, {FOLD_SQL} FROM target",
        counted="SELECT f.fold AS held, label, count(*) FILTER (WHERE l.fold <> f.fold) AS fitted, "
                "count(*) FILTER (WHERE l.fold = f.fold) AS judged FROM labelled l, (SELECT DISTINCT fold FROM labelled) f GROUP BY 1, 2",
        folds="SELECT held, arg_max(judged, fitted * 100 - label) / CAST(sum(judged) AS DOUBLE) AS a FROM counted GROUP BY held",
        whole="SELECT arg_max(label, n * 100 - label) AS label, max(n) / CAST(sum(n) AS DOUBLE) AS a "
              "FROM (SELECT label, count(*) AS n FROM labelled GROUP BY 1)", **extra)


QUERIES: dict[str, Query] = {
    "i1_majority_by_given_folds": Query(
        lambda s, d: rounded(models.fold_mean_frame(s, majority(s, d))),
        _majority_sql(f"SELECT '{{\"maxDepth\": 0}}' AS params, {_by_fold} FROM folds")),
    "i3_majority_result_row": Query(
        lambda s, d: rounded(models.result_frame(s, [majority(s, d)])),
        _majority_sql("SELECT 'tree' AS model, '{\"maxDepth\": [0]}' AS hyperparameters, '{\"maxDepth\": 0}' AS best_parameters, "
                      f"{_all_rows} FROM whole")),
    "i14_majority_logged_and_retrained": Query(
        lambda s, d: rounded(read_table(s, majority_log(s, d)).drop("path")),
        _majority_sql("SELECT 'segments' AS name, v.version, 'tree' AS kind, 'plain' AS features, '{\"maxDepth\": 0}' AS parameters, "
                      f"{_all_rows} FROM whole, (SELECT 1 AS version UNION ALL SELECT 2) v")),
    "i15_majority_predictions": Query(
        majority_predicted,
        _majority_sql("SELECT id, label AS prediction FROM fresh, (SELECT label FROM whole)",
                      fresh="SELECT id FROM typed WHERE " + " AND ".join(r for n, r in RULE_SQL.items() if n != "valid_segmentation"))),
    "b15_dense_vectors": Query(
        lambda s, d: C.vector_to_rows(C.densify(gold_features(s, d, False))), _features_query(False)),
    "b19_training_frames": Query(loaded_frames, _labelled_sql),
    "i1_cross_validation": Query(grid_scores),
    "i2_model_comparison": Query(compared),
    "i3_result_rows": Query(appended_results),
    "i4_logistic_regression": Query(
        validated("logistic", {"maxIter": [20], "regParam": [0.01], "elasticNetParam": [0.0, 1.0]}, scale=True)),
    "i4_logistic_regression_vectors": Query(
        lambda s, d: models.result_frame(s, [models.cross_validate("logistic", vectors(s, d), {"maxIter": [20]}, folds=2)])),
    "i5_random_forest": Query(validated("forest", {"numTrees": [5, 10], "maxDepth": [5], "minInstancesPerNode": [1]})),
    "i6_decision_tree": Query(validated("tree", {"maxDepth": [3, 5], "minInstancesPerNode": [1]})),
    "i7_perceptron": Query(perceptron),
    "i9_forest_by_fold": Query(forest_by_fold),
    "i10_random_search": Query(randomly_searched),
    "i11_boosted_trees": Query(validated("boosted", {"maxIter": [3], "maxDepth": [3]})),
    "i11_softmax_boosting": Query(validated("softmax_boosted", {"maxIter": [4], "maxDepth": [3]})),
    "i11_softmax_one_split": Query(one_split, _one_split_sql),
    "i11_softmax_priors": Query(boosted_priors, _priors_sql),
    "i12_kernel_support_vectors": Query(
        validated("kernel_support_vector", {"kernel": ["rbf", "poly"], "size": [64], "maxIter": [5], "regParam": [0.1]}, scale=True)),
    "i12_support_vectors": Query(validated("support_vector", {"maxIter": [5], "regParam": [0.1]}, scale=True)),
    "i13_best_model_logged": Query(best_logged),
    "i14_retrained": Query(retrained),
    "i15_batch_predictions": Query(predicted),
}
