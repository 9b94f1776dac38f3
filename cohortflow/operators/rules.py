"""Named row rules: keep, split off, count. Works on batch and on streaming frames (all but the counts)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def holds(rule: str) -> Column:
    """True where the rule is true; a rule that evaluates to NULL does not hold."""
    return F.coalesce(F.expr(rule), F.lit(False))


def all_hold(rules: Mapping[str, str]) -> Column:
    return F.expr(" AND ".join(f"({rule})" for rule in rules.values()))


def keep_valid(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows for which every rule is true. Written as a plain conjunction, so each part can reach the scan."""
    return df.filter(all_hold(rules))


def keep_single(df: DataFrame, rule: str) -> DataFrame:
    """Rows for which one rule is true; apply several in turn to stack them."""
    return df.filter(F.expr(rule))


def failed_rules(rules: Mapping[str, str]) -> Column:
    """Names of the rules a row breaks."""
    return F.array_compact(F.array(*[F.when(~holds(rule), F.lit(name)) for name, rule in rules.items()]))


def quarantine(df: DataFrame, rules: Mapping[str, str], name: str = "failed_rules") -> DataFrame:
    """The exact complement of keep_valid, with the names of the broken rules."""
    return df.filter(~F.coalesce(all_hold(rules), F.lit(False))).withColumn(name, failed_rules(rules))


def _totals(rules: Mapping[str, str]) -> list[Column]:
    """One row of counts: all rows, and per rule the rows that pass it and those that pass it and all earlier ones."""
    totals, stacked = [F.count(F.lit(1)).alias("_rows")], F.lit(True)
    for i, rule in enumerate(rules.values()):
        stacked = stacked & holds(rule)
        totals += [F.count_if(holds(rule)).alias(f"_p{i}"), F.count_if(stacked).alias(f"_s{i}")]
    return totals


def _report(totals: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows of counts as one row per rule."""
    lines = [F.struct(
        F.lit(name).alias("rule"), F.col(f"_p{i}").alias("passed"),
        (F.col("_rows") - F.col(f"_p{i}")).alias("failed"), F.col(f"_s{i}").alias("left_after")) for i, name in enumerate(rules)]
    return totals.select(*[c for c in totals.columns if not c.startswith("_")], F.inline(F.array(*lines)))


def rule_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Per rule: rows that pass, rows that fail, and rows left once this and all earlier rules are applied."""
    return _report(df.agg(*_totals(rules)), rules)


def observed(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """df, and an observation that counts what the rules do while df is read for something else; put it before any filter."""
    seen = Observation()
    return df.observe(seen, *_totals(rules)), seen


def observed_report(spark: SparkSession, seen: Observation, rules: Mapping[str, str], **marks: object) -> DataFrame:
    """rule_report's rows from an observation whose frame has been written; marks are constant columns in front."""
    counts = {**marks, **seen.get}
    return _report(spark.createDataFrame([tuple(counts.values())], list(counts)), rules)


def null_flags(columns: list[str]) -> Column:
    """Number of NULLs among the columns of a row."""
    flags = [F.col(c).isNull().cast("int") for c in columns]
    total = flags[0]
    for flag in flags[1:]:
        total = total + flag
    return total


def rows_with_nulls(df: DataFrame, columns: list[str] | None = None, more_than: int = 0) -> DataFrame:
    """Rows with more than the given number of NULLs in the columns."""
    return df.filter(null_flags(columns or df.columns) > more_than)


def duplicated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows. Such ids multiply rows in a join."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
