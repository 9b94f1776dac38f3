"""The regular jobs, from a CSV folder to scored rows. Each reads and writes named places and can run on its own:

ingest -> layers -> refit -> features -> select -> (retrain) -> score

The first feature job needs the stages that a refit job has saved.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from cohortflow import config
from cohortflow.operators.features import features_of, fit_features
from cohortflow.operators.models import Outcome, result_frame
from cohortflow.plans import lifecycle, medallion, selection
from cohortflow.session import settle
from cohortflow.sources.files import read_csv
from cohortflow.sources.models import load_stages, save_model
from cohortflow.sources.tables import append_rows, read_table, write_table
from cohortflow.streaming.ingest import append_available, csv_stream

COMMENTS = {
    "silver": "Valid profiles for training",
    "quarantine": "Profiles that break a rule, with the rules they break",
    "gold_lookup": "Value maps of the encoded columns",
    "gold_target": "Encoded segment per profile",
    "gold_complete": "Encoded and imputed profiles",
    "gold_scaled": "Feature vectors with scaled numbers",
    "gold_plain": "Feature vectors with unscaled numbers",
}


@dataclass(frozen=True)
class Places:
    """Where the jobs read and write. bronze and the model and stage folders are paths; the others are
    table names, or paths where they hold a slash."""
    bronze: str
    offsets: str
    silver: str
    quarantine: str
    gold_lookup: str
    gold_target: str
    gold_complete: str
    gold_scaled: str
    gold_plain: str
    stages_scaled: str
    stages_plain: str
    results: str
    model_log: str
    models: str
    predictions: str

    @classmethod
    def below(cls, folder: str) -> Places:
        return cls(**{f.name: f"{folder.rstrip('/')}/{f.name}" for f in fields(cls)})


def _write(df: DataFrame, places: Places, name: str) -> None:
    write_table(df, getattr(places, name), comment=COMMENTS.get(name))


def ingest(spark: SparkSession, source: str, places: Places, max_files: int = 1) -> None:
    """Append the files that have arrived since the last run."""
    stream = csv_stream(spark, source, config.raw_schema(), max_files)
    append_available(stream, places.bronze, places.offsets).awaitTermination()


def layers(spark: SparkSession, places: Places, median_error: float = 0.01) -> None:
    """Recompute silver, quarantine and the gold tables that need no fitted stages."""
    bronze = spark.read.parquet(places.bronze)
    _write(medallion.silver(bronze), places, "silver")
    _write(medallion.silver_quarantine(bronze), places, "quarantine")
    silver = read_table(spark, places.silver)
    _write(medallion.gold_lookup(spark), places, "gold_lookup")
    _write(medallion.gold_target(silver), places, "gold_target")
    _write(medallion.gold_complete(silver, median_error), places, "gold_complete")


def refit(spark: SparkSession, places: Places) -> None:
    """Fit and save both variants of the feature stages."""
    inputs = medallion.feature_input(read_table(spark, places.silver))
    save_model(fit_features(inputs, scale=True), places.stages_scaled)
    save_model(fit_features(inputs, scale=False), places.stages_plain)


def features(spark: SparkSession, places: Places) -> None:
    """Feature tables from the saved stages."""
    inputs = medallion.feature_input(read_table(spark, places.silver))
    for stages, target in (("stages_scaled", "gold_scaled"), ("stages_plain", "gold_plain")):
        _write(features_of(inputs, load_stages(getattr(places, stages)), ["id"]), places, target)


def training_frames(spark: SparkSession, places: Places) -> tuple[DataFrame, DataFrame]:
    return selection.load_training_frames(spark, places.gold_scaled, places.gold_plain, places.gold_target)


def select(spark: SparkSession, places: Places, name: str, candidates: dict | None = None, **options) -> Outcome:
    """Compare the candidates, append their result rows, save and log the best."""
    scaled, plain = training_frames(spark, places)
    outcomes = selection.compare_models(scaled, plain, candidates, **options)
    append_rows(result_frame(spark, outcomes), places.results)
    return lifecycle.register_best(spark, outcomes, places.model_log, places.models, name)


def score(spark: SparkSession, source: str, places: Places, name: str) -> DataFrame:
    """Segment the valid rows of a label-free CSV folder and append the predictions."""
    schema = config.struct_from_fields([f for f in config.RAW_FIELDS if f[0] != "Segmentation"])
    fresh = medallion.silver(read_csv(spark, source, schema), config.SCORING_RULES)
    current = lifecycle.required_version(spark, places.model_log, name)
    stages = places.stages_scaled if current["features"] == "scaled" else places.stages_plain
    out = settle(lifecycle.predict(spark, medallion.feature_input(fresh), stages, places.model_log, name))
    append_rows(out, places.predictions)
    return out


def retrain(spark: SparkSession, places: Places, name: str) -> int:
    """Fit the current configuration on the current feature tables and log it as the next version."""
    scaled, plain = training_frames(spark, places)
    current = lifecycle.required_version(spark, places.model_log, name)
    df = scaled if current["features"] == "scaled" else plain
    return lifecycle.retrain(spark, df, places.model_log, places.models, name)
