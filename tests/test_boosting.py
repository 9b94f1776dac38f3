import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortflow.operators import boosting, models
from cohortflow.operators.boosting import SoftmaxBooster, SoftmaxBoostingModel, Tree, _drawn, binned
from cohortflow.session import settle

SCHEMA = "id long, x array<double>, label double"


def made(spark, n, seed=1, width=4):
    """Three classes from two halves and a product that no single feature tells."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] * x[:, 2] > 0).astype(int)
    rows = [(i, Vectors.dense(v), float(c)) for i, (v, c) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, ["id", "features", "label"]), x, y


def brute_round(x, y, classes, cuts, step, penalty, depth, least):
    """One round by the definition: the best split of every node by trying all, Newton leaves; returns scores."""
    n = len(y)
    share = np.bincount(y, minlength=classes) / n
    scores = np.tile(np.log(share), (n, 1))
    p = np.tile(share, (n, 1))
    for c in range(classes):
        g, h = p[:, c] - (y == c), p[:, c] * (1 - p[:, c])

        def grow(rows, level):
            value = -step * g[rows].sum() / (h[rows].sum() + penalty)
            best = None
            if level < depth:
                for f in range(x.shape[1]):
                    for cut in cuts[f]:
                        left = rows[x[rows, f] <= cut]
                        right = rows[x[rows, f] > cut]
                        if min(len(left), len(right)) < least:
                            continue
                        score = [g[r].sum() ** 2 / (h[r].sum() + penalty) for r in (left, right, rows)]
                        gain = 0.5 * (score[0] + score[1] - score[2])
                        if best is None or gain > best[0] + 1e-12:
                            best = (gain, left, right)
            if best is None or best[0] <= 0:
                scores[rows, c] += value
            else:
                grow(best[1], level + 1)
                grow(best[2], level + 1)

        grow(np.arange(n), 0)
    e = np.exp(scores)
    return e / e.sum(1, keepdims=True)


@pytest.mark.parametrize("depth, least", [(0, 1), (1, 1), (2, 5)])
def test_one_round_is_that_of_the_definition(spark, depth, least):
    df, x, y = made(spark, 150)
    model = SoftmaxBooster(maxIter=1, maxDepth=depth, stepSize=0.5, minInstancesPerNode=least, maxBins=8).fit(df.repartition(3))
    want = brute_round(x, y, 3, model.cuts, 0.5, 1.0, depth, least)
    for r in model.transform(df).collect():
        assert r["probability"] == pytest.approx(want[r["id"]].tolist(), abs=1e-9)
        assert r["prediction"] == int(np.argmax(want[r["id"]]))
    assert model.losses[1][0] == pytest.approx(-np.log(want[np.arange(150), y]).mean(), abs=1e-9)


def test_held_out_loss_falls_and_beats_one_versus_rest(spark):
    df, _, _ = made(spark, 1500, 5)
    learnt, judged = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    model = SoftmaxBooster(maxIter=9, maxDepth=3, stepSize=0.4, heldOut=0.2).fit(learnt)  # scores are written anew once
    held = [h for _, h in model.losses]
    assert all(b < a for a, b in zip(held[:6], held[1:7], strict=True))
    other = models.classifier("boosted", {"maxIter": 9, "maxDepth": 3, "stepSize": 0.4}).fit(learnt)
    assert models.scores_of(model, judged)["f1_score"] > models.scores_of(other, judged)["f1_score"]
    truth = {r["id"]: (int(r["label"]), r["probability"]) for r in model.transform(judged).collect()}
    assert sum(-math.log(p[c]) for c, p in truth.values()) / len(truth) < 0.75 * held[0]


def test_boosting_stops_when_nothing_is_learnt(spark):
    rng = random.Random(3)
    rows = [(i, Vectors.dense([rng.random()]), float(rng.randrange(2))) for i in range(200)]
    model = SoftmaxBooster(maxIter=30, maxDepth=3, stepSize=1.0, heldOut=0.3, patience=2).fit(spark.createDataFrame(rows, ["id", "features", "label"]))
    held = [h for _, h in model.losses]
    assert len(model.trees) == len(held) - 1 < 30 and held[-1] == min(held)


def test_sampled_rows_and_features(spark):
    df, _, _ = made(spark, 300)
    options = {"maxIter": 2, "maxDepth": 2, "subsamplingRate": 0.7, "featureRate": 0.5, "seed": 4}
    one, two = SoftmaxBooster(**options).fit(df), SoftmaxBooster(**options).fit(df.repartition(5))
    assert [[t.feature for t in r] for r in one.trees] == [[t.feature for t in r] for r in two.trees]
    assert all(len({f for f in t.feature if f >= 0}) <= 2 for r in one.trees for t in r)
    keys = np.arange(10_000, dtype=np.int64)
    assert 0.66 < _drawn(keys, 1, 0.7).mean() < 0.74 and (_drawn(keys, 1, 0.7) != _drawn(keys, 2, 0.7)).any()


def test_odd_values_and_labels(spark):
    rows = [(1, Vectors.dense([float("nan"), 1.0]), 0.0), (2, Vectors.sparse(2, {}), 2.0), (3, Vectors.dense([5.0, 1.0]), 2.0), (4, Vectors.dense([1.0, 1.0]), None)]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    model = SoftmaxBooster(maxIter=2, maxDepth=2, stepSize=1.0).fit(df)
    out = {r["id"]: r for r in model.transform(df).collect()}
    assert len(out) == 4 and all(abs(sum(r["probability"]) - 1) < 1e-9 for r in out.values())
    assert all(r["probability"][1] < 1e-9 for r in out.values())  # a class without rows
    with pytest.raises(ValueError):
        SoftmaxBooster().fit(df.filter("label IS NULL"))
    assert model.transform(df.limit(0)).count() == 0
    assert binned(np.array([[1.0], [1.5], [2.0], [np.nan]]), [[1.0, 2.0]]).ravel().tolist() == [0, 1, 1, 2]


def test_saved_inside_a_pipeline(spark, tmp_path):
    df, _, _ = made(spark, 120)
    fitted = Pipeline(stages=[SoftmaxBooster(maxIter=2, maxDepth=2, predictionCol="guess")]).fit(df)
    fitted.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert isinstance(again.stages[0], SoftmaxBoostingModel) and isinstance(again.stages[0].trees[0][0], Tree)
    one, two = (sorted((r["id"], r["guess"], tuple(r["probability"])) for r in m.transform(df).collect()) for m in (fitted, again))
    assert one == two


def test_grid_search_takes_it_like_any_other(spark):
    df, _, _ = made(spark, 300)
    outcome = models.cross_validate("softmax_boosted", df, {"maxIter": [1, 4], "maxDepth": [3], "stepSize": [0.5]}, folds=2)
    assert outcome.best_params["maxIter"] == 4 and outcome.fold_f1[1] > outcome.fold_f1[0]


def test_a_task_hands_out_its_sums_once(spark, monkeypatch):
    df, x, y = made(spark, 400)
    rows = df.select(F.col("label").cast("int").alias("label"), F.col("id").alias("key"), vector_to_array("features").alias("x")).coalesce(1)
    cuts = [[-1.0, 0.0, 1.0]] * 4
    value = {"seed": 1, "heldOut": 0.0, "subsamplingRate": 1.0}
    grower = boosting._Grower(cuts, 3, [0.0] * 3, value)
    state = settle(grower._start(rows), "state")
    tree = [Tree([-1], [0], [0], [0.0])] * 3
    found = {}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        for most in (1 << 19, 0):
            monkeypatch.setattr(boosting, "MOST_CELLS", most)
            cells = grower._sums(state, [], tree, [[0]] * 3, [[0, 1, 2, 3]] * 3, 0, False).collect()
            found[most] = cells, {}
            for r in cells:
                place = (r["class"], r["node"], r["feature"], r["bin"])
                found[most][1][place] = found[most][1].get(place, np.zeros(3)) + [r["g"], r["h"], r["n"]]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    # eight batches of one task: a row per cell in one case, rows of each batch in the other, the same sums
    assert len(found[1 << 19][0]) == len(found[1 << 19][1]) < len(found[0][0])
    assert found[1 << 19][1].keys() == found[0][1].keys()
    assert all(found[0][1][k] == pytest.approx(v) for k, v in found[1 << 19][1].items())
    binned_x = binned(x, cuts)
    assert all(found[0][1][c, 0, f, b][2] == (binned_x[:, f] == b).sum() for c in range(3) for f in range(4) for b in np.unique(binned_x[:, f]))


def test_matrices_are_read_where_they_lie():
    values = np.arange(12, dtype=np.float64).reshape(4, 3)
    column = pa.array([v.tobytes() for v in values], pa.binary())
    assert boosting._matrix(column, np.float64, 3).tolist() == values.tolist()
    part = boosting._matrix(column.slice(1, 2), np.float64, 3)
    assert part.tolist() == values[1:3].tolist() and np.shares_memory(part, np.frombuffer(column.buffers()[2], np.uint8))
