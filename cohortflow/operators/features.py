"""Feature vectors: impute, scale, index, one-hot, assemble; and flag columns."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, RobustScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions.columns import cast_columns, columns_of, mapped, numeric_columns

MISSING = "missing"


def median_imputer(columns: list[str], relative_error: float = 0.001) -> Imputer:
    return Imputer(inputCols=columns, outputCols=columns, strategy="median", relativeError=relative_error)


def text_indexer(columns: list[str]) -> StringIndexer:
    """Most frequent value first, ties alphabetical; NULL and unseen values share the last index."""
    return StringIndexer(inputCols=columns, outputCols=[f"{c}_index" for c in columns], handleInvalid="keep")


def one_hot(columns: list[str]) -> OneHotEncoder:
    return OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_ohe" for c in columns],
                         handleInvalid="keep")


def robust_scaler(source: str = "numerical_assembled", target: str = "numerical_scaled",
                  relative_error: float = 0.001) -> RobustScaler:
    """x / (third quartile - first quartile), not centred."""
    return RobustScaler(inputCol=source, outputCol=target, relativeError=relative_error)


def feature_stages(num_cols: list[str], string_cols: list[str], scale: bool = False,
                   relative_error: float = 0.001) -> Pipeline:
    """The whole feature preparation, with or without scaling. Every numeric column is imputed,
    so a NULL that first appears after fitting is filled as well."""
    stages, parts = [], []
    if num_cols:
        numbers = "numerical_assembled"
        stages += [median_imputer(num_cols, relative_error), VectorAssembler(inputCols=num_cols, outputCol=numbers)]
        if scale:
            scaler = robust_scaler(relative_error=relative_error)
            stages.append(scaler)
            numbers = scaler.getOutputCol()
        parts.append(numbers)
    if string_cols:
        encoder = one_hot(string_cols)
        stages += [text_indexer(string_cols), encoder]
        parts += encoder.getOutputCols()
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol="features")])


def feature_frame(df: DataFrame) -> DataFrame:
    """Booleans as integers, because medians are not defined on booleans."""
    return cast_columns(df, dict.fromkeys(columns_of(df, T.BooleanType), "int"))


def check_levels(df: DataFrame, columns: list[str], max_levels: int | None) -> None:
    """Refuse columns with more distinct values than the caller allows, counted exactly; without a limit none is refused.
    The fitted levels are kept on the driver."""
    if max_levels is None:
        return
    widths = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first() if columns else {}
    wide = [c for c in columns if widths[c] > max_levels]
    if wide:
        raise ValueError(f"more than {max_levels} levels in {wide}; leave these columns out")


def fit_features(df: DataFrame, scale: bool = False, numeric_types: str = "int_bool_double",
                 skip: tuple[str, ...] = ("id",), relative_error: float = 0.001, max_levels: int | None = None) -> PipelineModel:
    """Fit the stages on the columns that the schema offers."""
    df = feature_frame(df)
    num_cols = [c for c in numeric_columns(df, numeric_types) if c not in skip]
    string_cols = [c for c in columns_of(df, T.StringType) if c not in skip]
    check_levels(df, string_cols, max_levels)
    return feature_stages(num_cols, string_cols, scale, relative_error).fit(df)


def features_of(df: DataFrame, model: PipelineModel, keep: list[str]) -> DataFrame:
    """The kept columns (the id) and the feature vector."""
    return model.transform(feature_frame(df)).select(*keep, "features")


def levels_of(df: DataFrame, columns: list[str], max_levels: int | None = None) -> dict[str, list]:
    """Sorted distinct values per column, NULL last. Refuses columns with more than max_levels, if given."""
    check_levels(df, columns, max_levels)
    row = df.agg(*[F.collect_set(c).alias(c) for c in columns],
                 *[F.bool_or(F.col(c).isNull()).alias(f"{c}_null") for c in columns]).first()
    return {c: sorted(row[c]) + ([None] if row[f"{c}_null"] else []) for c in columns}


def flag_columns(df: DataFrame, onehot: list[str], ordinal: dict[str, list[str]],
                 levels: dict[str, list] | None = None) -> DataFrame:
    """One 0/1 column per level (NULL is a level of its own), ordered codes, and the rest unchanged."""
    levels = levels or levels_of(df, onehot)
    flags = [F.col(c).eqNullSafe(F.lit(level)).cast("double").alias(f"{c}_{MISSING if level is None else level}")
             for c in onehot for level in levels[c]]
    codes = [mapped(c, {level: float(i) for i, level in enumerate(order)}).alias(c) for c, order in ordinal.items()]
    rest = [F.col(c) for c in df.columns if c not in onehot and c not in ordinal]
    return df.select(*flags, *codes, *rest)
