"""Names, casts, fills, value maps and roles. Each function is one projection over its input."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOOKUP_SCHEMA = "string_value string, numeric_value double, column string"


def replace_columns(df: DataFrame, changed: Mapping[str, Column]) -> DataFrame:
    """Exchange the given columns in place; all others pass through."""
    return df.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in df.columns])


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case names with underscores for spaces."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


#: What every text that casts to a number has: a digit, or the letters of a spelled-out value (NaN, Inf, Infinity).
LIKE_A_NUMBER = r"\p{Nd}|[nN][aA][nN]|[iI][nN][fF]"
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _fitted(column: str, now: str, kind: str) -> Column:
    """try_cast; text without anything of a number is not tried, because each failed try costs an exception."""
    tried = F.col(column).try_cast(kind)
    return F.when(F.col(column).rlike(LIKE_A_NUMBER), tried) if now == "string" and kind.startswith(NUMBERS) else tried


def cast_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit becomes NULL. Columns of that type already stay untouched,
    so filters on them still reach the scan."""
    current = dict(df.dtypes)
    return replace_columns(
        df, {c: _fitted(c, current[c], kind) for c, kind in kinds.items() if current[c] != kind})


def cast_to_double(columns: Iterable[str], *frames: DataFrame) -> tuple[DataFrame, ...]:
    """The same columns as double in every given frame (training, test)."""
    kinds = dict.fromkeys(columns, "double")
    return tuple(cast_columns(frame, kinds) for frame in frames)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*names)


def fill_constants(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """NULL -> constant, per column."""
    return df.fillna(dict(fills))


def mapped(column: str | Column, mapping: Mapping, default: object = None) -> Column:
    """Value map as an expression; values outside the map, and NULL, give the default."""
    column = F.col(column) if isinstance(column, str) else column
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    found = F.try_element_at(F.create_map(*pairs), column)
    return found if default is None else F.coalesce(found, F.lit(default))


def map_values(df: DataFrame, maps: Mapping[str, Mapping], default: object = None) -> DataFrame:
    return replace_columns(df, {c: mapped(c, m, default) for c, m in maps.items()})


def shift_labels(df: DataFrame, column: str = "label", classes: int = 4) -> DataFrame:
    """Labels 1..n become 0..n-1; anything else becomes NULL."""
    label = F.col(column)
    return replace_columns(df, {column: F.when(label.isin(*range(1, classes + 1)), label - 1)})


def rename_cast(df: DataFrame, old: str, new: str, kind: str) -> DataFrame:
    return df.select(*[F.col(c).cast(kind).alias(new) if c == old else F.col(c) for c in df.columns])


def column_type(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def columns_of(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    """Names of the columns that have one of the given types, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame, numeric_types: str = "int_bool_double") -> list[str]:
    """Columns that count as numeric features.

    'int_bool_double' leaves float and long columns out; 'all' takes every numeric type.
    """
    if numeric_types == "all":
        return columns_of(df, T.NumericType, T.BooleanType)
    return columns_of(df, T.IntegerType, T.BooleanType, T.DoubleType)


def null_count(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def column_roles(df: DataFrame, numeric_types: str = "int_bool_double") -> dict[str, list[str]]:
    """Numeric and string columns, and those among them with NULLs: one aggregate over the table."""
    numeric, text = numeric_columns(df, numeric_types), columns_of(df, T.StringType)
    counts = df.agg(*[null_count(c).alias(c) for c in numeric + text]).first()
    return {
        "num_cols": numeric,
        "string_cols": text,
        "num_missing_cols": [c for c in numeric if counts[c]],
        "string_missing_cols": [c for c in text if counts[c]],
    }


def dense(column: str = "features") -> Column:
    """A vector column with every value in dense form."""
    return array_to_vector(vector_to_array(F.col(column)))


def densify(df: DataFrame, column: str = "features") -> DataFrame:
    return replace_columns(df, {column: dense(column)})


def vector_size(df: DataFrame, column: str = "features") -> int:
    """Slots of a vector column, from the column metadata, or from one row where that is missing."""
    known = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    return known or df.select(F.size(vector_to_array(column))).first()[0]


def vector_to_columns(df: DataFrame, column: str = "features", size: int | None = None,
                      prefix: str = "f") -> DataFrame:
    """One double column per vector slot; the other columns stay."""
    size = size or vector_size(df, column)
    slots = vector_to_array(F.col(column))
    return (df.withColumn("_slots", slots)
            .select(*[F.col(c) for c in df.columns if c != column],
                    *[F.col("_slots")[i].alias(f"{prefix}{i}") for i in range(size)]))


def vector_to_rows(df: DataFrame, column: str = "features", digits: int | None = 6) -> DataFrame:
    """One row per vector slot: the other columns, pos, value."""
    keep = [c for c in df.columns if c != column]
    long = df.select(*keep, F.posexplode(vector_to_array(F.col(column))).alias("pos", "value"))
    return long if digits is None else long.withColumn("value", F.round("value", digits))


def json_text(*columns: str) -> Column:
    """The given columns as one JSON object."""
    return F.to_json(F.struct(*columns))


def round_doubles(df: DataFrame, digits: int = 5) -> DataFrame:
    """Round every double column."""
    return replace_columns(df, {c: F.round(c, digits) for c in columns_of(df, T.DoubleType)})


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique but not consecutive ids. They depend on the partitioning: never join on them."""
    return df.withColumn(name, F.monotonically_increasing_id())


def lookup_frame(spark: SparkSession, mapping: Mapping, column: str) -> DataFrame:
    """One column's value map as rows."""
    rows = [(str(key), float(value), column) for key, value in mapping.items()]
    return spark.createDataFrame(rows, LOOKUP_SCHEMA)


def lookup_union(spark: SparkSession, maps: Mapping[str, Mapping]) -> DataFrame:
    """The value maps of several columns below each other, duplicates kept."""
    frames = [lookup_frame(spark, mapping, column) for column, mapping in maps.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out
