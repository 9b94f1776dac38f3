"""Mode and median imputation: one aggregate job per strategy, then one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.columns import replace_columns
from cohortflow.operators.stats import medians, modes


def impute_mode(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL -> most frequent value. A column in which NULL itself is most frequent is left as it is."""
    found = {r["column_name"]: r["value"] for r in modes(df, columns).collect()}  # one row per column
    fills = {c: F.coalesce(F.col(c), F.lit(found[c]).cast(df.schema[c].dataType))
             for c in columns if found.get(c) is not None}
    return replace_columns(df, fills)


def impute_median(df: DataFrame, columns: list[str], error: float = 0.01) -> DataFrame:
    """NULL -> median (an existing value within the rank error), in the column's own type."""
    found = medians(df, columns, error)
    fills = {c: F.coalesce(F.col(c), F.lit(found[c]).cast(df.schema[c].dataType))
             for c in columns if found[c] is not None}
    return replace_columns(df, fills)
