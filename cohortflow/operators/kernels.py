"""Explicit feature maps for non-linear kernels, as a fitted and saved stage in front of a linear machine.

The inner product of two mapped rows is near the kernel of the rows, so a linear support vector machine on mapped rows is a
kernel machine whose cost grows with the rows and not with their square. Rows are mapped batch by batch with matrix products.

rbf: exp(-gamma |x - y|^2) by random Fourier features, cosines of random projections.
poly: (gamma x.y + coef0) ^ degree by tensor sketches, products of hashed sums in the frequency domain.
sigmoid: tanh(gamma x.y + coef0) by Nystroem landmarks, rows chosen by a hash and whitened by their own kernel matrix; the
kernel is not positive for all rows, and what is negative in the matrix is left out.
gamma: a number, 'auto' (1 / columns) or 'scale' (1 / (columns * variance of all values)).
"""

from __future__ import annotations

import json
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The Python stage travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KERNELS = ("rbf", "poly", "sigmoid")


def kernel(name: str, x: np.ndarray, y: np.ndarray, gamma: float, degree: int = 3, coef0: float = 0.0) -> np.ndarray:
    """The kernel of every row of x with every row of y."""
    if name == "rbf":
        return np.exp(-gamma * np.maximum(0.0, (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T))
    inner = gamma * (x @ y.T) + coef0
    return inner ** degree if name == "poly" else np.tanh(inner)


def rbf_map(x: np.ndarray, gamma: float, size: int, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    to = draw.normal(scale=np.sqrt(2 * gamma), size=(x.shape[1], size))
    return np.sqrt(2 / size) * np.cos(x @ to + draw.uniform(0, 2 * np.pi, size))


def poly_map(x: np.ndarray, gamma: float, degree: int, coef0: float, size: int, seed: int) -> np.ndarray:
    if coef0 < 0:
        raise ValueError("coef0 of a polynomial kernel is 0 or more")
    draw = np.random.default_rng(seed)
    rows = np.column_stack([np.sqrt(gamma) * x, np.full(len(x), np.sqrt(coef0))])
    out = np.ones((len(x), size // 2 + 1), complex)
    for _ in range(degree):
        place, sign = draw.integers(0, size, rows.shape[1]), draw.choice([-1.0, 1.0], rows.shape[1])
        table = np.zeros((rows.shape[1], size))
        table[np.arange(rows.shape[1]), place] = sign
        out *= np.fft.rfft(rows @ table, axis=1)
    return np.fft.irfft(out, n=size, axis=1)


class _MapParams(HasFeaturesCol, HasOutputCol, HasSeed):
    kernel = Param(Params._dummy(), "kernel", "rbf, poly or sigmoid", TypeConverters.toString)
    gamma = Param(Params._dummy(), "gamma", "a number, 'scale' or 'auto'", TypeConverters.identity)
    degree = Param(Params._dummy(), "degree", "of a polynomial kernel", TypeConverters.toInt)
    coef0 = Param(Params._dummy(), "coef0", "added to inner products", TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "length of a mapped row; of sigmoid at most", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(featuresCol="features", outputCol="mapped", seed=13, kernel="rbf", gamma="scale", degree=3, coef0=0.0, size=256)


class KernelMap(Estimator, _MapParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits gamma and, for sigmoid, at most `size` landmark rows. Rows without features are not learnt from."""

    @keyword_only
    def __init__(self, *, featuresCol="features", outputCol="mapped", seed=13, kernel="rbf", gamma="scale", degree=3, coef0=0.0, size=256):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> KernelMapModel:
        name, gamma, size = (self.getOrDefault(p) for p in ("kernel", "gamma", "size"))
        if name not in KERNELS or not (gamma in ("scale", "auto") or float(gamma) > 0):
            raise ValueError(f"kernel is one of {KERNELS}, gamma above 0, 'scale' or 'auto'")
        features = F.col(self.getOrDefault("featuresCol"))
        rows = df.filter(features.isNotNull()).select(vector_to_array(features).alias("x"))
        total = lambda of: F.sum(F.aggregate("x", F.lit(0.0), lambda s, v: s + of(v)))
        found = rows.agg(F.max(F.size("x")).alias("width"), F.count(F.lit(1)).alias("n"), total(lambda v: v).alias("s"), total(lambda v: v * v).alias("q")).first()
        if not found["n"] or not found["width"]:
            raise ValueError("no row to learn from")
        width, cells = found["width"], found["n"] * found["width"]
        spread = found["q"] / cells - (found["s"] / cells) ** 2
        number = float(gamma) if gamma not in ("scale", "auto") else 1 / (width * (spread if gamma == "scale" and spread > 0 else 1.0))
        landmarks = []
        if name == "sigmoid":  # `size` rows, whatever the input
            marked = rows.distinct().orderBy(F.xxhash64(F.lit(self.getOrDefault("seed")), "x"), "x").limit(size)
            landmarks = [list(r["x"]) for r in marked.collect()]
        return self._copyValues(KernelMapModel(width, number, landmarks))


class KernelMapModel(Model, _MapParams, MLWritable, MLReadable):
    """Adds the mapped row as a vector; a row without features stays without."""

    def __init__(self, width: int = 0, number: float = 0.0, landmarks=()):
        super().__init__()
        self._defaults()
        self.width, self.number, self.landmarks = width, number, [list(x) for x in landmarks]

    def mapper(self):
        """A function from a matrix of rows to the mapped rows."""
        name, degree, coef0, size, seed = (self.getOrDefault(p) for p in ("kernel", "degree", "coef0", "size", "seed"))
        gamma, landmarks = self.number, np.array(self.landmarks, float).reshape(-1, self.width)
        if name == "rbf":
            return lambda x: rbf_map(x, gamma, size, seed)
        if name == "poly":
            return lambda x: poly_map(x, gamma, degree, coef0, size, seed)
        values, vectors = np.linalg.eigh(kernel(name, landmarks, landmarks, gamma, coef0=coef0))
        used = values > 1e-6 * values.max()
        whiten = vectors[:, used] / np.sqrt(values[used])
        return lambda x: kernel(name, x, landmarks, gamma, coef0=coef0) @ whiten

    def _transform(self, df: DataFrame) -> DataFrame:
        to, width = self.mapper(), self.width

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def mapped(x: pd.Series) -> pd.Series:
            rows = [v for v in x if v is not None]
            found = iter(to(np.stack(rows).astype(float).reshape(-1, width)) if rows else ())
            return pd.Series([None if v is None else next(found) for v in x], dtype=object)

        features = F.col(self.getOrDefault("featuresCol"))
        made = mapped(F.when(features.isNotNull(), vector_to_array(features)))
        name = self.getOrDefault("outputCol")
        return df.withColumn(name, made).withColumn(name, F.when(F.col(name).isNotNull(), array_to_vector(F.col(name))))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: KernelMapModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession)
        text = json.dumps({"width": m.width, "number": m.number, "landmarks": m.landmarks})
        self.sparkSession.createDataFrame([(text,)], "model string").coalesce(1).write.parquet(f"{path}/data")


class _Reader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> KernelMapModel:
        spark = self.sparkSession or SparkSession.active()
        model = self.cls(**json.loads(spark.read.parquet(f"{path}/data").first()["model"]))
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
