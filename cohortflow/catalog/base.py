"""Tables and derived frames shared by the registered queries, as frames and as SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortflow import config
from cohortflow.plans import medallion

# The profile view: NULLs, out-of-range values, invalid segments and ties over the whole customer table.
# The text runs unchanged on Spark and on ANSI SQL engines.
PROFILE = {
    "id": "CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE c_custkey END",
    "gender": "CASE WHEN c_custkey % 29 = 3 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END",
    "ever_married": "CASE WHEN c_custkey % 19 = 4 THEN NULL WHEN c_custkey % 5 < 3 THEN 'Yes' ELSE 'No' END",
    "age": "CASE WHEN c_custkey % 17 = 2 THEN NULL ELSE CAST((c_custkey * 37) % 140 - 10 AS INT) END",
    "graduated": "CASE WHEN c_custkey % 23 = 6 THEN NULL WHEN c_custkey % 8 < 5 THEN 'Yes' ELSE 'No' END",
    "profession": "CASE c_nationkey % 10 WHEN 0 THEN NULL WHEN 1 THEN 'Artist' WHEN 2 THEN 'Doctor' "
                  "WHEN 3 THEN 'Engineer' WHEN 4 THEN 'Entertainment' WHEN 5 THEN 'Executive' "
                  "WHEN 6 THEN 'Healthcare' WHEN 7 THEN 'Homemaker' WHEN 8 THEN 'Lawyer' ELSE 'Marketing' END",
    "work_experience": "CASE WHEN c_custkey % 9 = 1 THEN NULL ELSE CAST(c_custkey % 53 AS FLOAT) END",
    "spending_score": "CASE WHEN c_acctbal < 3000 THEN 'Low' WHEN c_acctbal < 7000 THEN 'Average' ELSE 'High' END",
    "family_size": "CASE WHEN c_custkey % 31 = 7 THEN NULL ELSE CAST(c_custkey % 18 - 1 AS FLOAT) END",
    "var_1": "CASE WHEN c_custkey % 37 = 8 THEN NULL "
             "ELSE concat('Cat_', CAST(c_nationkey % 7 + 1 AS VARCHAR(2))) END",
    "segmentation": "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'A' WHEN 'BUILDING' THEN 'B' WHEN 'FURNITURE' THEN 'C' "
                    "WHEN 'HOUSEHOLD' THEN 'D' ELSE CASE WHEN c_custkey % 2 = 0 THEN 'Z' ELSE NULL END END",
}
PROFILE_COLUMNS = list(PROFILE)
ATTRIBUTES = [c for c in PROFILE_COLUMNS if c not in ("id", "segmentation")]


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*[f"{text} AS {name}" for name, text in PROFILE.items()])


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.silver(profile(spark, sf_dir))


def feature_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.feature_input(silver(spark, sf_dir))


# SQL side. A CASE per cast keeps float -> int truncating, as in Spark.
_profile_sql = "SELECT " + ", ".join(f"{text} AS {name}" for name, text in PROFILE.items()) + " FROM customer"
_typed_sql = ("SELECT id, gender, ever_married, CAST(age AS INT) AS age, graduated, profession, "
              "CAST(work_experience AS FLOAT) AS work_experience, spending_score, "
              "CAST(trunc(family_size) AS INT) AS family_size, var_1, segmentation FROM profile")
RULE_SQL = {name: f"coalesce(({rule}), FALSE)" for name, rule in config.ROW_RULES.items()}
ALL_RULES_SQL = " AND ".join(RULE_SQL.values())


def case_map(column: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {column} {whens} END"


_inputs_sql = ("SELECT id, gender, coalesce(ever_married, 'No') AS ever_married, age, graduated, "
               "coalesce(profession, 'Other') AS profession, work_experience, spending_score, family_size, var_1 "
               "FROM silver")
_encoded_sql = ("SELECT id, " + ", ".join(
    f"{case_map(c, config.VALUE_MAPS[c])} AS {c}" if c in config.VALUE_MAPS else c for c in ATTRIBUTES) +
    " FROM inputs")

CTES = {
    "profile": _profile_sql,
    "typed": _typed_sql,
    "silver": f"SELECT * FROM typed WHERE {ALL_RULES_SQL}",
    "inputs": _inputs_sql,
    "encoded": _encoded_sql,
    "target": f"SELECT id, coalesce({case_map('segmentation', config.TARGET_MAP)}, {config.TARGET_DEFAULT}) "
              "AS segmentation FROM silver",
}
_order = list(CTES)


def with_ctes(upto: str, body: str, **extra: str) -> str:
    """body with all shared CTEs up to the named one, then the given ones, in front."""
    shared = {n: CTES[n] for n in _order[:_order.index(upto) + 1]}
    parts = ", ".join(f"{name} AS ({text})" for name, text in {**shared, **extra}.items())
    return f"WITH {parts} {body}"


def union_all(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)
