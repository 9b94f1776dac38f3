"""Fold assignment as a column, so membership is an equality and never a list of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.operators.ranking import number_rows


def shuffle_key(id_column: str, seed: int):
    """A seeded order of ids that any engine reproduces."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))


def stratified_folds(df: DataFrame, label: str, id_column: str, folds: int = 3, seed: int = 13,
                     name: str = "fold") -> DataFrame:
    """Folds 0..k-1 whose sizes differ by at most one within each label.

    A label that holds most of the rows is still spread over all sort partitions.
    """
    keyed = df.withColumn("_shuffle", shuffle_key(id_column, seed))
    numbered = number_rows(keyed, ["_shuffle", id_column], group_by=[label], name="_row")
    return numbered.withColumn(name, ((F.col("_row") - 1) % folds).cast("int")).drop("_row", "_shuffle")


def fold_split(df: DataFrame, fold: int, name: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(training rows, validation rows) of one fold."""
    return df.filter(F.col(name) != fold), df.filter(F.col(name) == fold)
