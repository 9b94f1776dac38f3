"""Fitted stages for table columns: what training's values give is saved and applied to rows that come later.

Modes, medians and levels are learnt once; a model holds them as plain parameters, so that saving and loading is that of any
stage, and a pipeline of these stages and of features.feature_stages scores new rows with training's values alone.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions.columns import map_values, replace_columns
from cohortflow.operators.features import flag_columns, levels_of
from cohortflow.operators.stats import medians, modes


class _Shared(Params):
    columns = Param(Params._dummy(), "columns", "column names", TypeConverters.toListString)

    def given(self, name: str):
        return self.getOrDefault(name)


class ValueFill(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Learns what to put for NULL: given constants, else a column's mode or median.

    Constants are filled first, so a mode counts them. A column whose most frequent value is NULL, or that has no number to take a
    median of, is left as it is. Values of text, numbers and booleans can be kept.
    """

    constants = Param(Params._dummy(), "constants", "column -> value", TypeConverters.identity)
    modes = Param(Params._dummy(), "modes", "columns filled with their mode", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "columns filled with their median", TypeConverters.toListString)
    error = Param(Params._dummy(), "error", "rank error of medians, 0 is exact", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, constants=None, modes=None, medians=None, error=0.01):
        super().__init__()
        self._setDefault(constants={}, modes=[], medians=[], error=0.01)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> ValueFillModel:
        fills = dict(self.given("constants"))
        filled = _filled(df, fills)
        if self.given("modes"):
            fills |= {r["column_name"]: r["value"] for r in modes(filled, self.given("modes")).collect() if r["value"] is not None}  # a row per column
        if self.given("medians"):
            fills |= {c: v for c, v in medians(filled, self.given("medians"), self.given("error")).items() if v is not None}
        return ValueFillModel(fills=fills)


def _filled(df: DataFrame, fills: dict) -> DataFrame:
    return replace_columns(df, {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in fills.items() if c in df.columns})


class ValueFillModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """NULL -> the kept value of the column; columns that the frame lacks are passed over."""

    fills = Param(Params._dummy(), "fills", "column -> value", TypeConverters.identity)

    @keyword_only
    def __init__(self, *, fills=None):
        super().__init__()
        self._setDefault(fills={})
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return _filled(df, self.given("fills"))


class ValueMap(Transformer, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Value maps of several columns; values outside a map, and NULL, become NULL."""

    maps = Param(Params._dummy(), "maps", "column -> {value -> number}", TypeConverters.identity)

    @keyword_only
    def __init__(self, *, maps=None):
        super().__init__()
        self._setDefault(maps={})
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        return map_values(df, {c: m for c, m in self.given("maps").items() if c in df.columns})


class LevelFlags(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the levels of the columns, NULL among them where it occurs; ordered: column -> its levels in order."""

    ordered = Param(Params._dummy(), "ordered", "column -> levels in order", TypeConverters.identity)
    maxLevels = Param(Params._dummy(), "maxLevels", "levels of a column, at most; 0: any number", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, columns=None, ordered=None, maxLevels=0):
        super().__init__()
        self._setDefault(columns=[], ordered={}, maxLevels=0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> LevelFlagsModel:
        columns = self.given("columns")
        levels = levels_of(df, columns, self.given("maxLevels") or None) if columns else {}
        return LevelFlagsModel(levels=levels, ordered=self.given("ordered"))


class LevelFlagsModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """A 0/1 column per level of training, codes for ordered columns, the rest unchanged. A level that training didn't have
    has no flag set, and no code."""

    levels = Param(Params._dummy(), "levels", "column -> levels", TypeConverters.identity)
    ordered = Param(Params._dummy(), "ordered", "column -> levels in order", TypeConverters.identity)

    @keyword_only
    def __init__(self, *, levels=None, ordered=None):
        super().__init__()
        self._setDefault(levels={}, ordered={})
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        levels = self.given("levels")
        return flag_columns(df, list(levels), self.given("ordered"), levels) if levels or self.given("ordered") else df
