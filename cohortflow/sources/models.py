"""Saved and loaded fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_stages(path: str) -> PipelineModel:
    return PipelineModel.load(path)
