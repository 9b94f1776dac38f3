"""Declared schemas and column roles, as defaults and as files."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import types as T

try:
    import yaml
except ImportError:  # JSON files still load
    yaml = None

CONF = Path(__file__).parent / "conf"

# Column names, types, roles, value maps and row rules of a profile table.
RAW_FIELDS = [
    ("ID", "IntegerType"), ("Gender", "StringType"), ("Ever_Married", "StringType"), ("Age", "IntegerType"),
    ("Graduated", "StringType"), ("Profession", "StringType"), ("Work_Experience", "FloatType"),
    ("Spending_Score", "StringType"), ("Family_Size", "FloatType"), ("Var_1", "StringType"),
    ("Segmentation", "StringType"),
]
SILVER_TYPES = {"age": "int", "family_size": "int", "work_experience": "float"}
QUARANTINE_TYPES = {"age": "int", "family_size": "int", "work_experience": "double"}
CATEGORICAL = ["ever_married", "graduated", "gender", "spending_score", "profession", "var_1"]
ONEHOT = ["profession", "var_1"]
NUMERICAL = ["age", "family_size", "work_experience"]
CONSTANT_FILLS = {"profession": "Other", "ever_married": "No"}
VALUE_MAPS = {
    "ever_married": {"Yes": 1, "No": 0},
    "graduated": {"Yes": 1, "No": 0},
    "gender": {"Male": 1, "Female": 0},
    "spending_score": {"Low": 0, "Average": 1, "High": 2},
}
TARGET_MAP = {"A": 1, "B": 2, "C": 3, "D": 4}
TARGET_DEFAULT = 4
ROW_RULES = {
    "valid_id": "id IS NOT NULL",
    "valid_segmentation": "segmentation IS NOT NULL AND segmentation IN ('A', 'B', 'C', 'D')",
    "non_negative_age": "age >= 0 OR age IS NULL",
    "valid_age": "age <= 120 OR age IS NULL",
    "valid_family_size": "family_size >= 0 AND family_size <= 15 OR family_size IS NULL",
    "valid_work_experience": "work_experience >= 0 AND work_experience <= 50 OR work_experience IS NULL",
}
# The same limits as single reject conditions. Kept rows must meet one after the other, and as they exclude
# each other nothing is left: the report shows that, the quarantine table uses the complement of ROW_RULES.
REJECT_RULES = {
    "invalid_id": "id IS NULL",
    "invalid_segmentation": "segmentation IS NULL AND segmentation NOT IN ('A', 'B', 'C', 'D')",
    "negative_age": "age < 0",
    "invalid_age": "age > 120",
    "negative_family_size": "family_size < 0",
    "invalid_family_size": "family_size > 15",
    "negative_work_experience": "work_experience < 0",
    "invalid_work_experience": "work_experience > 50",
}
# Scoring data has no segment, so it is held to the other rules only.
SCORING_RULES = {name: rule for name, rule in ROW_RULES.items() if name != "valid_segmentation"}
# End of fixed values.


def load_config(path: str | Path) -> dict:
    """A YAML or JSON file as a dictionary."""
    text = Path(path).read_text()
    if str(path).endswith(".json"):
        return json.loads(text)
    if yaml is None:
        raise ImportError("PyYAML is needed for YAML files; use a .json file instead")
    return yaml.safe_load(text)


def struct_from_fields(fields: list[tuple[str, str]]) -> T.StructType:
    """(name, type name) pairs as a schema; every field is nullable."""
    return T.StructType([T.StructField(name, getattr(T, kind)(), True) for name, kind in fields])


def load_schema(path: str | Path, name: str) -> T.StructType:
    """The named schema of a file of schemas."""
    return struct_from_fields([(f["name"], f["type"]) for f in load_config(path)[name]])


def raw_schema() -> T.StructType:
    return struct_from_fields(RAW_FIELDS)


def value_maps(config: dict) -> dict[str, dict]:
    """Column -> value map, from a loaded gold configuration."""
    return {column: entry["mapping"] for entry in config["custom_mappings"] for column in entry["columns"]}
