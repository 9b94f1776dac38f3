"""Gradient boosting for several classes with one joint softmax loss.

A round fits one regression tree per class to the gradients of the log-loss of all classes together, and leaves take a
Newton step. Features are put into bins at sketched quantiles once. Each level of a round is one pass: tasks add up
gradients and second derivatives by (class, node, feature, bin) over all their batches of arrays, Spark sums them up, and
window sums over the bins give the gain of every split. Only the best split of each node reaches the driver, so many
rows as there are classes times nodes of a level. A part of the rows can be held out; boosting then stops when their loss
hasn't fallen for some rounds, and the model keeps the rounds up to the lowest loss.
"""

from __future__ import annotations

import json
import random
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.session import settle

# The Python stages travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rounds after which the rows' scores are written anew; in between, a pass adds the last rounds' trees itself.
WRITE_EVERY = 8
#: Cells (node, feature, bin) of a class that a task adds up over all its batches; beyond, it hands out each batch's sums.
MOST_CELLS = 1 << 19
#: Class numbers of the loss among the sums: of the rows that are learnt from, and of those held out.
LEARNT, HELD = -1, -2
SUMS = "class int, node int, feature int, bin int, g double, h double, n bigint"


class Tree(NamedTuple):
    """Nodes in arrays: feature (-1 at a leaf), last bin that goes left, left child (the right one follows), value."""

    feature: list[int]
    bin: list[int]
    left: list[int]
    value: list[float]

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node in which each row ends."""
        feature, cut, left = (np.array(x) for x in (self.feature, self.bin, self.left))
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while len(rows := rows[feature[at[rows]] >= 0]):
            here = at[rows]
            at[rows] = left[here] + (bins[rows, feature[here]] > cut[here])
        return at

    def values(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def binned(values: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Bin of each value: the number of its column's cuts below it; NaN lies above all."""
    return np.stack([np.searchsorted(np.array(c), values[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8) if cuts else np.zeros((len(values), 0), np.uint8)


def _drawn(keys: np.ndarray, turn: int, rate: float) -> np.ndarray:
    """Whether a row takes part in a turn: a hash of its key, the same wherever the row is read."""
    if rate >= 1:
        return np.ones(len(keys), bool)
    x = keys.view(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(rate * 2 ** 64))


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """A column of equally long binaries or lists as a matrix."""
    if not len(column):
        return np.zeros((0, width), kind)
    if pa.types.is_binary(column.type):
        _, offsets, data = column.buffers()
        first = np.frombuffer(offsets, np.int32)[column.offset]
        return np.frombuffer(data, kind, len(column) * width, first).reshape(len(column), width) if width else np.zeros((len(column), 0), kind)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


class _BoostingParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed):
    maxIter = Param(Params._dummy(), "maxIter", "rounds", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a leaf's step that is taken", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree; 0: a leaf alone", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows of a node, at least", TypeConverters.toInt)
    minInfoGain = Param(Params._dummy(), "minInfoGain", "gain of a split, at least", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of rows in a round", TypeConverters.toFloat)
    featureRate = Param(Params._dummy(), "featureRate", "share of features in a tree", TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "added to a leaf's second derivative", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, at most 256", TypeConverters.toInt)
    heldOut = Param(Params._dummy(), "heldOut", "share of rows held out to stop early", TypeConverters.toFloat)
    patience = Param(Params._dummy(), "patience", "rounds without a lower held-out loss before it stops", TypeConverters.toInt)


class SoftmaxBooster(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees with one softmax loss over all classes. Labels are 0 to n-1; rows without a label are left out."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", seed=13, maxIter=20,
                 stepSize=0.1, maxDepth=5, minInstancesPerNode=1, minInfoGain=0.0, subsamplingRate=1.0, featureRate=1.0, penalty=1.0,
                 maxBins=32, heldOut=0.0, patience=10):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", seed=13, maxIter=20,
                         stepSize=0.1, maxDepth=5, minInstancesPerNode=1, minInfoGain=0.0, subsamplingRate=1.0, featureRate=1.0, penalty=1.0,
                         maxBins=32, heldOut=0.0, patience=10)

    def _fit(self, df: DataFrame) -> SoftmaxBoostingModel:
        value = {p.name: self.getOrDefault(p) for p in self.params}
        if not 2 <= value["maxBins"] <= 256:
            raise ValueError("2 to 256 bins")
        rows = df.filter(F.col(value["labelCol"]).isNotNull()).select(
            F.col(value["labelCol"]).cast("int").alias("label"), vector_to_array(F.col(value["featuresCol"])).alias("x"))
        rows = settle(rows.withColumn("key", F.xxhash64(F.lit(value["seed"]), "label", "x")), "boosting")
        found = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).collect()  # a row per class
        if not found:
            raise ValueError("no labelled row")
        if min(r["label"] for r in found) < 0:
            raise ValueError("labels are 0 to n-1")
        classes, width = max(r["label"] for r in found) + 1, found[0]["width"]
        total = sum(r["n"] for r in found)
        share = np.zeros(classes)
        for r in found:
            share[r["label"]] = r["n"] / total
        base = np.log(np.maximum(share, 1e-12)).tolist()
        grower = _Grower(_bin_cuts(rows, width, value["maxBins"]), classes, base, value)
        trees, losses = grower.boost(rows)
        model = SoftmaxBoostingModel(grower.cuts, base, trees, losses)
        return self._copyValues(model)


def _bin_cuts(rows: DataFrame, width: int, bins: int) -> list[list[float]]:
    """Distinct sketched quantiles of every feature, the greatest value left out: values up to a cut go left of it."""
    probs = ", ".join(str(i / bins) for i in range(1, bins))
    accuracy = 50 * bins
    row = rows.select(*[F.expr(f"percentile_approx(nullif(x[{f}], double('NaN')), array({probs}), {accuracy})").alias(f"q{f}") for f in range(width)],
                      *[F.max(F.expr(f"nullif(x[{f}], double('NaN'))")).alias(f"m{f}") for f in range(width)]).first()
    return [[c for c in sorted(set(row[f"q{f}"] or [])) if c < row[f"m{f}"]] for f in range(width)]


class _Grower:
    """Rounds of trees over rows with bins (a byte per feature), label and scores."""

    def __init__(self, cuts: list[list[float]], classes: int, base: list[float], value: dict) -> None:
        self.cuts, self.classes, self.base, self.value = cuts, classes, base, value

    def boost(self, rows: DataFrame) -> tuple[list[list[Tree]], list[tuple[float, float | None]]]:
        """Trees by round and class, and the loss before each round and after the last: learnt and held-out rows."""
        value = self.value
        state = settle(self._start(rows), "binned")
        trees: list[list[Tree]] = []
        losses: list[tuple[float, float | None]] = []
        pending: list[list[Tree]] = []
        for turn in range(value["maxIter"] + 1):
            grown, loss = self._round(state, pending, turn, last=turn == value["maxIter"])
            losses.append(loss)
            best = min(range(len(losses)), key=lambda i: losses[i][1]) if loss[1] is not None else turn
            if grown is None or turn - best >= value["patience"]:
                break
            trees.append(grown)
            pending.append(grown)
            if len(pending) == WRITE_EVERY:
                state, pending = settle(self._rescored(state, pending), "scores"), []
        return (trees[:best], losses[:best + 1]) if losses[-1][1] is not None else (trees, losses)

    def _start(self, rows: DataFrame) -> DataFrame:
        cuts, base, width = self.cuts, self.base, len(self.cuts)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = binned(_matrix(batch.column("x"), float, width), cuts)
                scores = np.tile(np.array(base), (batch.num_rows, 1))
                yield _state(batch.column("label"), batch.column("key"), bins, scores)

        return rows.mapInArrow(run, "label int, key bigint, bins binary, scores binary")

    def _rescored(self, state: DataFrame, pending: list[list[Tree]]) -> DataFrame:
        read = self._reader(pending)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, _, bins, scores = read(batch)
                yield _state(batch.column("label"), batch.column("key"), bins, scores)

        return state.mapInArrow(run, state.schema)

    def _reader(self, pending: list[list[Tree]]):
        width, classes = len(self.cuts), self.classes

        def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            label, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "key"))
            bins = _matrix(batch.column("bins"), np.uint8, width)
            scores = _matrix(batch.column("scores"), np.float64, classes).copy()
            for trees in pending:
                for c, tree in enumerate(trees):
                    scores[:, c] += tree.values(bins)
            return label, key, bins, scores

        return read

    def _round(self, state: DataFrame, pending: list[list[Tree]], turn: int, last: bool) -> tuple[list[Tree] | None, tuple[float, float | None]]:
        """One tree per class, grown level by level, and the loss before; no trees in the last turn, which only takes the loss."""
        value, width = self.value, len(self.cuts)
        draw = random.Random(f"{value['seed']}-{turn}")
        taken = max(1, round(width * value["featureRate"])) if width else 0
        features = [sorted(draw.sample(range(width), taken)) for _ in range(self.classes)]
        trees = [Tree([-1], [0], [0], [0.0]) for _ in range(self.classes)]
        open_nodes = [[0] for _ in range(self.classes)]
        loss = (float("nan"), None)
        for level in range(value["maxDepth"] + 1):
            sums = self._sums(state, pending, trees, open_nodes, features, turn, last).groupBy("class", "node", "feature", "bin").agg(
                *[F.sum(c).alias(c) for c in ("g", "h", "n")])
            found = self._best(sums, level < value["maxDepth"]).collect()  # a row per open node, and two of the loss
            if level == 0:
                by = {r["class"]: r for r in found if r["class"] < 0}
                loss = (by[LEARNT]["g"] / by[LEARNT]["n"] if LEARNT in by else float("nan"), by[HELD]["g"] / by[HELD]["n"] if HELD in by else None)
                if last:
                    return None, loss
            following: list[list[int]] = [[] for _ in range(self.classes)]
            for r in sorted((r for r in found if r["class"] >= 0), key=lambda r: (r["class"], r["node"])):
                tree, node, split = trees[r["class"]], r["node"], r["split"]
                tree.value[node] = -value["stepSize"] * r["g"] / (r["h"] + value["penalty"])
                if split is not None and split["gain"] > value["minInfoGain"]:
                    tree.feature[node], tree.bin[node], tree.left[node] = -split["feature"], -split["bin"], len(tree.feature)
                    for g, h in ((split["g"], split["h"]), (r["g"] - split["g"], r["h"] - split["h"])):
                        following[r["class"]].append(len(tree.feature))
                        tree.feature.append(-1)
                        tree.bin.append(0)
                        tree.left.append(0)
                        tree.value.append(-value["stepSize"] * g / (h + value["penalty"]))
            open_nodes = following
            if not any(open_nodes) or level == value["maxDepth"] - 1:
                break  # a last level's leaves have their values from the split above
        return trees, loss

    def _sums(self, state: DataFrame, pending: list[list[Tree]], trees: list[Tree], open_nodes: list[list[int]], features: list[list[int]], turn: int, last: bool) -> DataFrame:
        """Gradients, second derivatives and rows by class, open node, feature and bin; feature -1 holds a node's total."""
        read, value, classes = self._reader(pending), self.value, self.classes
        seed, held_out, rate = value["seed"], value["heldOut"], value["subsamplingRate"]

        size = max((len(c) for c in self.cuts), default=0) + 1

        def told(parts: list[tuple]) -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            kinds = [pa.int32()] * 4 + [pa.float64()] * 2 + [pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["class", "node", "feature", "bin", "g", "h", "n"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lost = {LEARNT: [0.0, 0], HELD: [0.0, 0]}
            # by class: g, h and n by feature, and by node and bin
            sums = {c: np.zeros((3, 1 + len(features[c]), len(nodes) * size)) for c, nodes in enumerate(open_nodes)
                    if not last and nodes and len(nodes) * size * (1 + len(features[c])) <= MOST_CELLS}
            for batch in batches:
                label, key, bins, scores = read(batch)
                bins = np.ascontiguousarray(bins.T)
                share = softmax(scores)
                own = np.maximum(share[np.arange(len(label)), label], 1e-300) if len(label) else np.zeros(0)
                held = _drawn(key, -1 - seed % 1000, held_out) if held_out > 0 else np.zeros(len(label), bool)
                for number, rows in ((LEARNT, ~held), (HELD, held)):
                    lost[number][0] -= np.log(own[rows]).sum()
                    lost[number][1] += int(rows.sum())
                out = []
                taken = np.flatnonzero(~held & _drawn(key, turn, rate))
                for c in range(classes if not last else 0):
                    if not open_nodes[c]:
                        continue
                    place = np.full(len(trees[c].feature), -1)
                    place[open_nodes[c]] = np.arange(len(open_nodes[c]))
                    at = place[trees[c].leaves(bins.T[taken])]
                    rows, at = taken[at >= 0], at[at >= 0]
                    p = share[rows, c]
                    g, h = p - (label[rows] == c), p * (1 - p)
                    nodes = np.array(open_nodes[c])
                    for i, f in enumerate([-1, *features[c]]):
                        cell = at * size + (bins[f][rows] if f >= 0 else 0)
                        found = [np.bincount(cell, weights=x, minlength=len(nodes) * size) for x in (g, h, None)]
                        if c in sums:
                            sums[c][:, i] += found
                        else:
                            out.append(_told(c, nodes, f, size, *found))
                if out:
                    yield told(out)
            out = [(np.array([number]), np.zeros(1, np.int64), np.array([-1]), np.zeros(1, np.int64), np.array([loss]), np.zeros(1), np.array([n])) for number, (loss, n) in lost.items() if n]
            out += [_told(c, np.array(open_nodes[c]), f, size, *found[:, i]) for c, found in sums.items() for i, f in enumerate([-1, *features[c]])]
            if out:
                yield told(out)

        return state.mapInArrow(run, SUMS)

    def _best(self, sums: DataFrame, split: bool) -> DataFrame:
        """Per class and node its totals and, if wanted, its best split: gain, feature and last left bin (negative), left sums."""
        kind = "struct<gain:double,feature:int,bin:int,g:double,h:double>"
        if not split:
            return sums.filter("feature < 0").select("class", "node", "g", "h", "n", F.lit(None).cast(kind).alias("split"))
        place = Window.partitionBy("class", "node", "feature")
        upto = place.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        cells = sums.select("class", "node", "feature", "bin", *[F.sum(c).over(upto).alias(f"l{c}") for c in ("g", "h", "n")],
                            *[F.sum(c).over(place).alias(f"t{c}") for c in ("g", "h", "n")])
        penalty, least = self.value["penalty"], self.value["minInstancesPerNode"]

        def score(g: str, h: str) -> str:
            return f"power({g}, 2) / ({h} + {penalty!r}D)"

        gain = f"0.5D * ({score('lg', 'lh')} + {score('(tg - lg)', '(th - lh)')} - {score('tg', 'th')})"
        # ties: the first feature, then the first bin
        allowed = f"feature >= 0 AND ln >= {least} AND tn - ln >= greatest({least}, 1)"
        of = F.expr(f"CASE WHEN {allowed} THEN struct({gain} AS gain, -feature AS feature, -bin AS bin, lg AS g, lh AS h) END").cast(kind)
        return cells.groupBy("class", "node").agg(
            *[F.max(F.expr(f"CASE WHEN feature < 0 THEN t{c} END")).alias(c) for c in ("g", "h", "n")], F.max(of).alias("split"))


def _told(number: int, nodes: np.ndarray, feature: int, size: int, g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple:
    """Columns of the sums of one class and feature, by node and bin in a row."""
    some = np.flatnonzero(n)
    return np.full(len(some), number), nodes[some // size], np.full(len(some), feature), some % size, g[some], h[some], n[some].astype(np.int64)


def _state(label: pa.Array, key: pa.Array, bins: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    def rows(matrix: np.ndarray) -> pa.Array:
        data = np.ascontiguousarray(matrix).tobytes()
        step = len(data) // max(len(matrix), 1)
        return pa.BinaryArray.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(np.arange(0, len(data) + 1, step, dtype=np.int32) if step else np.zeros(len(matrix) + 1, np.int32)), pa.py_buffer(data)])

    return pa.RecordBatch.from_arrays([label, key, rows(bins), rows(scores.astype(np.float64))], ["label", "key", "bins", "scores"])


class SoftmaxBoostingModel(Model, _BoostingParams, MLWritable, MLReadable):
    """Cuts of the bins, base scores and trees; adds probability (one per class) and prediction.

    losses: the mean log-loss of learnt and held-out rows before each round and after the last one kept.
    """

    def __init__(self, cuts=(), base=(), trees=(), losses=()):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", seed=13)
        self.cuts, self.base = [list(c) for c in cuts], list(base)
        self.trees, self.losses = [[Tree(*t) for t in r] for r in trees], [tuple(x) for x in losses]

    def _transform(self, df: DataFrame) -> DataFrame:
        cuts, base, trees, width = self.cuts, self.base, self.trees, len(self.cuts)

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def probability(x):
            bins = binned(np.stack(x.to_numpy()).astype(float).reshape(len(x), width) if len(x) else np.zeros((0, width)), cuts)
            scores = np.tile(np.array(base), (len(bins), 1))
            for turn in trees:
                for c, tree in enumerate(turn):
                    scores[:, c] += tree.values(bins)
            import pandas as pd

            return pd.Series(list(softmax(scores)))

        name = self.getOrDefault(self.probabilityCol)
        out = df.withColumn(name, probability(vector_to_array(F.col(self.getOrDefault(self.featuresCol)))))
        top = F.array_position(F.col(name), F.array_max(F.col(name))) - 1
        return out.withColumn(self.getOrDefault(self.predictionCol), top.cast("double"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: SoftmaxBoostingModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession)
        text = json.dumps({"cuts": m.cuts, "base": m.base, "trees": m.trees, "losses": m.losses})
        self.sparkSession.createDataFrame([(text,)], "model string").coalesce(1).write.parquet(f"{path}/data")


class _Reader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> SoftmaxBoostingModel:
        spark = self.sparkSession or SparkSession.active()
        found = json.loads(spark.read.parquet(f"{path}/data").first()["model"])
        model = self.cls(found["cuts"], found["base"], found["trees"], found["losses"])
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
