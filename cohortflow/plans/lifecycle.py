"""Model log: save the best model, refit it on new data, score with it.

The log is a table with one row per saved version. The highest version of a name is the current one.
"""

from __future__ import annotations

import json

from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel, LogisticRegressionModel, MultilayerPerceptronClassificationModel, OneVsRestModel,
    RandomForestClassificationModel)
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cohortflow.functions.columns import densify
from cohortflow.operators.features import features_of
from cohortflow.operators.models import METRICS, Outcome, classifier, kept, scores_of
from cohortflow.sources.models import load_stages, save_model
from cohortflow.sources.tables import append_rows, read_table, table_exists

LOG_SCHEMA = ("name string, version int, kind string, features string, parameters string, path string, f1_score double, accuracy double, "
              "weighted_precision double, weighted_recall double")
LOADERS = {
    "logistic": LogisticRegressionModel, "forest": RandomForestClassificationModel,
    "tree": DecisionTreeClassificationModel, "perceptron": MultilayerPerceptronClassificationModel,
    "boosted": OneVsRestModel, "support_vector": OneVsRestModel,
}


def _log(spark: SparkSession, log: str, row: tuple) -> None:
    append_rows(spark.createDataFrame([row], LOG_SCHEMA), log)


def current_version(spark: SparkSession, log: str, name: str) -> Row | None:
    """The log row of the highest version."""
    return read_table(spark, log).filter(F.col("name") == name).orderBy(F.desc("version")).first()


def required_version(spark: SparkSession, log: str, name: str) -> Row:
    row = current_version(spark, log, name)
    if row is None:
        raise ValueError(f"no saved version of {name}")
    return row


def next_version(spark: SparkSession, log: str, name: str) -> int:
    """One above the highest version, 1 for a new name or a log that is not there yet."""
    if not table_exists(spark, log):
        return 1
    current = current_version(spark, log, name)
    return current["version"] + 1 if current else 1


def _store(spark: SparkSession, log: str, folder: str, name: str, version: int, kind: str, features: str,
           params: dict, model: Model, scores: dict) -> int:
    path = f"{folder.rstrip('/')}/{name}/{version}"
    save_model(model, path)
    _log(spark, log, (name, version, kind, features, json.dumps(params), path, *[float(scores[m]) for m in METRICS]))
    return version


def register_best(spark: SparkSession, outcomes: list[Outcome], log: str, folder: str, name: str) -> Outcome:
    """Save the refit model of the outcome with the best fold mean and log it as the next version."""
    best = max(outcomes, key=lambda o: o.best_f1)
    _store(spark, log, folder, name, next_version(spark, log, name), best.kind, best.features, best.best_params,
           best.model, best.resubstitution)
    return best


def retrain(spark: SparkSession, df: DataFrame, log: str, folder: str, name: str) -> int:
    """Fit the current configuration on new rows and log it as the next version."""
    current = required_version(spark, log, name)
    params = json.loads(current["parameters"])
    with kept(df) as df:  # read by every pass of the fit, and by the scores
        model = classifier(current["kind"], params).fit(df)
        return _store(spark, log, folder, name, current["version"] + 1, current["kind"], current["features"], params,
                      model, scores_of(model, df))


def current_model(spark: SparkSession, log: str, name: str) -> Model:
    row = required_version(spark, log, name)
    return LOADERS[row["kind"]].load(row["path"])


def predict(spark: SparkSession, df: DataFrame, feature_path: str, log: str, name: str, id_column: str = "id") -> DataFrame:
    """(id, prediction) for label-free rows: saved feature stages, then the current model."""
    features = densify(features_of(df, load_stages(feature_path), [id_column]))
    return current_model(spark, log, name).transform(features).select(id_column, "prediction")
