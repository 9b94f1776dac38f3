"""Classifier settings, parameter grids and cross-validation."""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest,
    RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions.columns import vector_size
from cohortflow.operators.boosting import SoftmaxBooster
from cohortflow.operators.folds import fold_split
from cohortflow.operators.kernels import KernelMap
from cohortflow.operators.metrics import METRICS, weighted_metrics
from cohortflow.session import settle

RESULT_SCHEMA = ("model string, hyperparameters string, best_parameters string, f1_score double, accuracy double, "
                 "weighted_precision double, weighted_recall double")
# Fold count, seed and parameter grids of the model comparison.
FOLDS, SEED = 3, 13
LOGISTIC_GRID = {"maxIter": [100], "regParam": [0.001, 0.01, 0.1], "elasticNetParam": [0.0, 1.0]}
FOREST_GRID = {"numTrees": [10, 50, 100], "maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 5, 10]}
TREE_GRID = {"maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 5, 10]}
PERCEPTRON_HIDDEN = [[16, 8], [68, 16], [68, 68]]
PERCEPTRON_GRID = {"maxIter": [50, 100, 200], "blockSize": [64, 128, 256]}
BOOSTED_SPACE = {"maxIter": [100, 200, 500], "stepSize": [0.01, 0.1, 0.2], "maxDepth": [3, 6, 12],
                 "minInstancesPerNode": [1, 3, 5], "subsamplingRate": [0.8, 0.9, 1.0]}
BOOSTED_RANGES = {"maxIter": ("quniform", 100, 500, 50), "stepSize": ("uniform", 0.05, 0.25), "maxDepth": ("quniform", 4, 12, 2)}
BOOSTED_FINE_RANGES = {"maxIter": ("quniform", 150, 300, 10), "stepSize": ("uniform", 0.02, 0.1),
                       "maxDepth": ("quniform", 2, 6, 1)}
SUPPORT_VECTOR_GRID = {"regParam": [10.0, 1.0, 0.1, 0.01]}
KERNEL_GRID = {"kernel": ["poly", "rbf", "sigmoid"], "degree": [2, 3, 4], "gamma": ["scale", "auto"], "coef0": [0.0, 0.5, 1.0], **SUPPORT_VECTOR_GRID}
FOREST_RANGES = {"numTrees": ("quniform", 10, 500, 25), "maxDepth": ("quniform", 3, 20, 1),
                 "maxBins": ("quniform", 32, 128, 16), "minInstancesPerNode": ("quniform", 1, 20, 1)}
SOFTMAX_SPACE = {**BOOSTED_SPACE, "minInfoGain": [0.0, 0.1, 0.5], "featureRate": [0.8, 0.9, 1.0]}
# End of fixed values.



def _without_session(learner: type) -> type:
    """The learner, whose models of two classes let go of their training summary. It holds the session, and a session
    in which anything was observed (DataFrame.observe) can't be sent to tasks, and the model with it."""
    def create(self, java_model):
        if java_model.numClasses() == 2 and java_model.hasSummary():
            java_model.setSummary(SparkContext.getOrCreate()._jvm.scala.Option.empty())
        return learner._create_model(self, java_model)

    return type(learner.__name__, (learner,), {"_create_model": create, "__module__": learner.__module__})


KINDS = {
    "logistic": _without_session(LogisticRegression),
    "forest": _without_session(RandomForestClassifier),
    "tree": DecisionTreeClassifier,
    "perceptron": MultilayerPerceptronClassifier,
    "boosted": GBTClassifier,
    "softmax_boosted": SoftmaxBooster,
    "support_vector": _without_session(LinearSVC),
}
BINARY_ONLY = ("boosted", "support_vector")
#: Settings of the feature map in front of a kernel machine; the others are the linear machine's.
MAP_SETTINGS = ("kernel", "gamma", "degree", "coef0", "size", "seed")
SEEDED = ("forest", "tree", "perceptron", "boosted", "softmax_boosted")


def classifier(kind: str, params: dict | None = None, features: str = "features", label: str = "label",
               seed: int = SEED) -> Estimator:
    """A classifier for any number of classes; two-class learners are wrapped one-versus-rest.

    kernel_support_vector: a support vector machine behind an explicit map of its kernel, as a pipeline.
    """
    settings = dict(params or {})
    if kind == "kernel_support_vector":
        settings.setdefault("seed", seed)
        first = KernelMap(featuresCol=features, outputCol="_mapped", **{k: v for k, v in settings.items() if k in MAP_SETTINGS})
        rest = {k: v for k, v in settings.items() if k not in MAP_SETTINGS}
        return Pipeline(stages=[first, classifier("support_vector", rest, "_mapped", label, seed)])
    if kind in SEEDED:
        settings.setdefault("seed", seed)
    base = KINDS[kind](featuresCol=features, labelCol=label, **settings)
    return OneVsRest(classifier=base, featuresCol=features, labelCol=label) if kind in BINARY_ONLY else base


def perceptron_grid(df: DataFrame, classes: int, features: str = "features", hidden=None, **grid) -> dict:
    """The first layer is as wide as the vector and the last as the number of classes."""
    width = vector_size(df, features)
    return {"layers": [[width, *h, classes] for h in (hidden or PERCEPTRON_HIDDEN)], **(grid or PERCEPTRON_GRID)}


def grid_points(grid: dict[str, list]) -> list[dict]:
    """All combinations of a grid."""
    points = [{}]
    for name, values in grid.items():
        points = [{**p, name: v} for p in points for v in values]
    return points


def random_points(space: dict, count: int, seed: int = SEED) -> list[dict]:
    """Seeded draws: from a list, ('uniform', low, high) or ('quniform', low, high, step)."""
    draw = random.Random(seed)

    def one(spec):
        if isinstance(spec, list):
            return draw.choice(spec)
        if spec[0] == "uniform":
            return draw.uniform(spec[1], spec[2])
        low, high, step = spec[1:]
        return min(high, max(low, int(round(draw.uniform(low, high) / step) * step)))

    return [{name: one(spec) for name, spec in space.items()} for _ in range(count)]


def scores_of(model: Model, df: DataFrame, label: str = "label") -> dict[str, float]:
    """The four metrics of a model's predictions, from one grouping."""
    row = weighted_metrics(model.transform(df).select(label, "prediction"), label).first()
    return {m: row[m] for m in METRICS}


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """The frame held in memory (disk where it does not fit) for as long as it is read again and again.
    It is written first, so a lost partition comes back with its rows in the same order and random folds
    stay as they were. It is dealt over all cores before: what comes out of a short file or a broadcast join is one
    partition, which every pass of every model would read in one task. A frame that the caller already keeps stays with the caller."""
    if df.is_cached:
        yield df
        return
    cores = df.sparkSession.sparkContext.defaultParallelism
    df = settle(df.repartition(cores), "training").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


@dataclass
class Outcome:
    """One cross-validated model: every point's fold mean, the best point, and its refit."""
    kind: str
    searched: object
    points: list[dict]
    fold_f1: list[float]
    best_params: dict
    model: Model
    resubstitution: dict[str, float]
    fold_scores: list[dict] = field(default_factory=list)
    features: str = "plain"  # which variant of the feature stages it was fitted on

    @property
    def best_f1(self) -> float:
        return max(self.fold_f1)

    def row(self) -> tuple:
        """Model, searched parameters, best parameters, metrics of the refit model on the data it was fitted on."""
        return (self.kind, json.dumps(self.searched), json.dumps(self.best_params),
                *[float(self.resubstitution[m]) for m in METRICS])


def cross_validate(kind: str, df: DataFrame, grid: dict, folds: int = FOLDS, seed: int = SEED,
                   label: str = "label", features: str = "features", parallelism: int = 4,
                   fold_column: str | None = None) -> Outcome:
    """Grid search with random folds, or with those of fold_column (stratified ones, say); the best mean weighted F1
    wins and is refit on all rows. Given folds keep all four metrics of every point and fold."""
    if kind in BINARY_ONLY or kind == "kernel_support_vector" or fold_column is not None:
        return search_points(kind, df, grid_points(grid), folds=folds, seed=seed, label=label, features=features,
                             fold_column=fold_column, parallelism=parallelism, searched=grid)
    base = classifier(kind, features=features, label=label, seed=seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(base.getParam(name), values)
    maps = builder.build()
    search = CrossValidator(estimator=base, estimatorParamMaps=maps, numFolds=folds, seed=seed, parallelism=parallelism,
                            evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="f1"))
    with kept(df) as df:
        fitted = search.fit(df)
        points = [{param.name: value for param, value in m.items()} for m in maps]
        best = max(range(len(points)), key=lambda i: fitted.avgMetrics[i])
        return Outcome(kind, grid, points, list(fitted.avgMetrics), points[best], fitted.bestModel,
                       scores_of(fitted.bestModel, df, label))


def search_points(kind: str, df: DataFrame, points: list[dict], folds: int = FOLDS, seed: int = SEED,
                  label: str = "label", features: str = "features", fold_column: str | None = None,
                  parallelism: int = 4, searched: object = None) -> Outcome:
    """Score given parameter points over folds (a fold column, or hashed folds), then refit the best."""
    if fold_column is None:
        fold_column = "_fold"
        df = df.withColumn(fold_column, F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(folds)).cast("int"))
    with kept(df) as df:
        splits = [fold_split(df, i, fold_column) for i in range(folds)]

        def score(task: tuple[int, int]) -> dict:
            point, fold = task
            train, held = splits[fold]
            model = classifier(kind, points[point], features, label, seed).fit(train)
            return {"point": point, "fold": fold, **scores_of(model, held, label)}

        tasks = [(p, f) for p in range(len(points)) for f in range(folds)]
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(inheritable_thread_target(df.sparkSession)(score), tasks))
        means = [sum(s["f1_score"] for s in scores if s["point"] == p) / folds for p in range(len(points))]
        best = max(range(len(points)), key=lambda i: means[i])
        model = classifier(kind, points[best], features, label, seed).fit(df)
        return Outcome(kind, searched if searched is not None else points, points, means, points[best], model,
                       scores_of(model, df, label), scores)


def random_search(kind: str, df: DataFrame, space: dict, count: int, seed: int = SEED, **options) -> Outcome:
    return search_points(kind, df, random_points(space, count, seed), seed=seed, searched=space, **options)


def result_frame(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    return spark.createDataFrame([o.row() for o in outcomes], RESULT_SCHEMA)


def point_frame(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    """Mean weighted F1 over the folds for every parameter point that was tried."""
    rows = [(o.kind, json.dumps(point), float(f1)) for o in outcomes for point, f1 in zip(o.points, o.fold_f1)]
    return spark.createDataFrame(rows, "model string, params string, f1_score double")


def fold_mean_frame(spark: SparkSession, outcome: Outcome) -> DataFrame:
    """The mean of every metric over the folds for every parameter point."""
    scores = fold_score_frame(spark, outcome)
    return scores.groupBy("params").agg(*[F.avg(m).alias(m) for m in METRICS])


def fold_score_frame(spark: SparkSession, outcome: Outcome) -> DataFrame:
    """One row per parameter point and fold."""
    rows = [(json.dumps(outcome.points[s["point"]]), s["fold"], *[float(s[m]) for m in METRICS])
            for s in outcome.fold_scores]
    return spark.createDataFrame(rows, "params string, fold int, " + ", ".join(f"{m} double" for m in METRICS))
