import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors

from cohortflow.operators import models
from cohortflow.operators.kernels import KernelMap, KernelMapModel, kernel


def frame(spark, x, y=None):
    y = np.zeros(len(x)) if y is None else y
    return spark.createDataFrame([(i, Vectors.dense(v), float(c)) for i, (v, c) in enumerate(zip(x, y, strict=True))], ["id", "features", "label"])


@pytest.mark.parametrize("options", [{"kernel": "rbf", "gamma": 0.3}, {"kernel": "rbf", "gamma": "scale"}, {"kernel": "poly", "degree": 2, "coef0": 1.0, "gamma": "auto"},
                                     {"kernel": "poly", "degree": 3, "coef0": 0.5, "gamma": 0.2}, {"kernel": "poly", "degree": 1, "gamma": 1.0}])
def test_inner_products_are_near_the_kernel(spark, options):
    x = np.random.default_rng(2).normal(size=(40, 5))
    model = KernelMap(size=8192, **options).fit(frame(spark, x))
    mapped = model.mapper()(x)
    exact = kernel(options["kernel"], x, x, model.number, options.get("degree", 3), options.get("coef0", 0.0))
    length = np.sqrt(np.diag(exact))
    # the error of a sum of random terms: a few times length * length / sqrt(size)
    assert np.abs(mapped @ mapped.T - exact).max() <= 6 * (length.max() ** 2) / np.sqrt(8192)


def test_sigmoid_is_exact_on_its_landmarks(spark):
    x = np.random.default_rng(3).normal(size=(12, 3)) * 0.4
    model = KernelMap(kernel="sigmoid", gamma=0.5, coef0=0.0, size=50).fit(frame(spark, x))
    exact = kernel("sigmoid", x, x, 0.5)
    values, vectors = np.linalg.eigh(exact)
    positive = (vectors * np.maximum(values, 0)) @ vectors.T
    mapped = model.mapper()(x)
    assert np.allclose(mapped @ mapped.T, positive, atol=1e-4)


def test_gamma_from_the_rows(spark):
    x = np.random.default_rng(4).normal(size=(50, 4)) * 3
    assert KernelMap(gamma="scale").fit(frame(spark, x)).number == pytest.approx(1 / (4 * x.var()))
    assert KernelMap(gamma="auto").fit(frame(spark, x)).number == 0.25
    assert KernelMap(gamma="scale").fit(frame(spark, np.ones((3, 4)))).number == 0.25  # no variance
    with pytest.raises(ValueError):
        KernelMap(kernel="cubic").fit(frame(spark, x))
    with pytest.raises(ValueError):
        KernelMap().fit(frame(spark, x).limit(0))


def test_rings_that_no_line_separates(spark):
    rng = np.random.default_rng(5)
    angle, y = rng.uniform(0, 2 * np.pi, 600), np.arange(600) % 3
    x = np.column_stack([np.cos(angle), np.sin(angle)]) * (1 + y[:, None]) + rng.normal(scale=0.1, size=(600, 2))
    df = frame(spark, x, y)
    learnt, judged = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    plain = models.classifier("support_vector", {"maxIter": 30}).fit(learnt)
    curved = models.classifier("kernel_support_vector", {"kernel": "rbf", "gamma": 1.0, "size": 100, "maxIter": 30, "regParam": 0.001}).fit(learnt)
    assert models.scores_of(plain, judged)["accuracy"] < 0.6 < 0.95 < models.scores_of(curved, judged)["accuracy"]


def test_saved_and_loaded(spark, tmp_path):
    x = np.random.default_rng(6).normal(size=(30, 3))
    df = frame(spark, x, np.arange(30) % 2)
    fitted = models.classifier("kernel_support_vector", {"kernel": "sigmoid", "size": 8, "gamma": 0.4, "maxIter": 3}).fit(df)
    fitted.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert isinstance(again.stages[0], KernelMapModel)
    one, two = (sorted((r["id"], r["prediction"], tuple(r["_mapped"])) for r in m.transform(df).collect()) for m in (fitted, again))
    assert one == two and len(one[0][2]) <= 8


def test_rows_without_features_and_empty_frames(spark):
    df = spark.createDataFrame([(1, Vectors.dense([1.0, 2.0])), (2, None), (3, Vectors.sparse(2, {0: 1.0}))], ["id", "features"])
    model = KernelMap(size=16, gamma=1.0).fit(df)
    out = {r["id"]: r["mapped"] for r in model.transform(df).collect()}
    assert out[2] is None and len(out[1]) == 16 and model.transform(df.limit(0)).count() == 0
