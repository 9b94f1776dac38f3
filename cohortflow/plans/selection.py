"""Training frames and model comparison."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from cohortflow.functions.columns import densify, rename_cast, shift_labels
from cohortflow.operators.joins import equi_join
from cohortflow.operators.models import FOREST_GRID, LOGISTIC_GRID, Outcome, cross_validate, kept
from cohortflow.sources.tables import read_table


def training_frame(features: DataFrame, target: DataFrame, id_column: str = "id") -> DataFrame:
    """id, dense features, label 0..n-1 as double."""
    joined = equi_join(features, shift_labels(target, "segmentation"), id_column)
    return densify(rename_cast(joined, "segmentation", "label", "double"))


def load_training_frames(spark: SparkSession, scaled: str, plain: str, target: str) -> tuple[DataFrame, DataFrame]:
    """The scaled and the unscaled training frame from three tables."""
    labels = read_table(spark, target)
    return training_frame(read_table(spark, scaled), labels), training_frame(read_table(spark, plain), labels)


def compare_models(scaled: DataFrame, plain: DataFrame, candidates: dict | None = None, **options) -> list[Outcome]:
    """Cross-validate (kind, grid) candidates on the scaled and on the unscaled features."""
    candidates = candidates or {"scaled": [("logistic", LOGISTIC_GRID)], "plain": [("forest", FOREST_GRID)]}
    outcomes = []
    for side, df in (("scaled", scaled), ("plain", plain)):
        if candidates.get(side):
            with kept(df) as df:  # read by every grid point and fold
                outcomes += [replace(cross_validate(kind, df, grid, **options), features=side)
                             for kind, grid in candidates[side]]
    return outcomes
