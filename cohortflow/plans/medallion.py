"""Layered tables: raw -> silver and quarantine -> gold tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import config
from cohortflow.functions.columns import cast_columns, fill_constants, lookup_union, map_values, mapped, normalize_names
from cohortflow.operators.impute import impute_median, impute_mode
from cohortflow.operators.rules import keep_valid, observed, observed_report, quarantine
from cohortflow.sources.tables import write_table


def typed(bronze: DataFrame, kinds: Mapping[str, str] = config.SILVER_TYPES) -> DataFrame:
    """Standard names and types. Rules are checked on this frame, after the casts."""
    return cast_columns(normalize_names(bronze), kinds)


def silver(bronze: DataFrame, rules: Mapping[str, str] = config.ROW_RULES) -> DataFrame:
    """Rows that pass every rule. Scoring data uses config.SCORING_RULES."""
    return keep_valid(typed(bronze), rules)


def write_silver(bronze: DataFrame, target: str, rules: Mapping[str, str] = config.ROW_RULES) -> DataFrame:
    """Write silver and return what each rule did, counted by the write itself: bronze is read once."""
    seen_rows, seen = observed(typed(bronze), rules)
    write_table(keep_valid(seen_rows, rules), target)
    return observed_report(bronze.sparkSession, seen, rules)


def silver_quarantine(bronze: DataFrame, rules: Mapping[str, str] = config.ROW_RULES) -> DataFrame:
    """Every row silver leaves out, with the rules it breaks, in the quarantine's own types.

    The rules judge the same values as in silver; a wider type could put a value on the other side of a bound.
    """
    named = normalize_names(bronze)
    found = typed(bronze, config.QUARANTINE_TYPES).columns
    both = named.withColumns({f"_found_{c}": F.col(c) for c in config.QUARANTINE_TYPES})
    judged = quarantine(cast_columns(both, config.SILVER_TYPES), rules)
    wide = cast_columns(judged, {f"_found_{c}": kind for c, kind in config.QUARANTINE_TYPES.items()})
    return wide.select(*[F.col(f"_found_{c}").alias(c) if c in config.QUARANTINE_TYPES else F.col(c) for c in found],
                       "failed_rules")


def gold_lookup(spark: SparkSession, maps: Mapping[str, Mapping] = config.VALUE_MAPS) -> DataFrame:
    return lookup_union(spark, maps)


def gold_target(silver_df: DataFrame) -> DataFrame:
    """(id, segmentation 1..4)"""
    return silver_df.select("id", mapped("segmentation", config.TARGET_MAP, config.TARGET_DEFAULT)
                            .alias("segmentation"))


def feature_input(silver_df: DataFrame) -> DataFrame:
    """Profile columns with the constant fills; the id is carried along, the segment and load times are not."""
    return fill_constants(silver_df.drop("segmentation", "ingest_timestamp", "inserted_at"), config.CONSTANT_FILLS)


def gold_complete(silver_df: DataFrame, median_error: float = 0.01) -> DataFrame:
    """Filled, mapped and imputed columns, id last: two aggregate jobs, no join."""
    encoded = map_values(feature_input(silver_df), config.VALUE_MAPS)
    imputed = impute_median(impute_mode(encoded, config.CATEGORICAL), config.NUMERICAL, median_error)
    return imputed.select(*[c for c in imputed.columns if c != "id"], "id")
