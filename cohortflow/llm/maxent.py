"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

A token is scored given the three before it. Features are the previous token, the ones two and three back (skips), and
the hashed pair of the last two. The softmax is factored: first the class of the next token, then the token within its
class. Classes are runs of the most frequent words by rank; one more class holds all other words, and is split by a tree
of choices between two ways down to leaves of some LEAF_WORDS words by hash, four levels of it by a line of contexts of
their own. Within a leaf a word's share follows its count. Every word is a context of its own at every step, hashed with the step into rows whose
number follows from the number of different words. Weights start at the unigram shares and are trained by gradient
updates that Spark distributes: in every round each task goes over its part of the training texts from the common
weights, and the changes of each GROUP of weights are averaged, by numbers of tokens, over the tasks that changed it.
Each training text is used in exactly one round.

Words are known by 64-bit hashes. Counts cover all training tokens. The FREQUENT most frequent words' counts, a fixed
number, and the counts of the leaves travel to every task; tokens beyond them are joined with the table of counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from cohortflow.llm.shipping import ship_package
from cohortflow.llm.words import slices, words_of
from cohortflow.session import settle

#: Classes of frequent words and words in each; one more class holds the rest.
CLASSES, WORDS = 16, 32
FREQUENT = 1 << 19
#: Hashed rows of the pair feature in a model without fine rows.
PAIRS = 1 << 13
#: Different words of a leaf, at least; there are as many leaves as that allows, in a power of two.
LEAF_WORDS = 16
#: Fine rows are the power of two from FINE times the square root of the number of different words on.
FINE, LEAST_FINE = 64, 1 << 10
#: Buckets of rare words as context.
RARE = 32
ROUNDS, RATE, BATCH = 4, 0.15, 8192
#: Floats of the model that are averaged as one row, and rows that are averaged as one group.
BLOCK, FAN_IN = 1 << 15, 64
#: Weights of a line, half a fine row and as long as what a processor reads at once; the tree's levels by one line: 15 nodes.
LINE, LEVELS = 16, 4
#: Neighbouring weights that are averaged over the same tasks: a fine row.
GROUP = WORDS
#: Tasks of a round at most, beyond LEAST_TASKS: so many for each time that the training tokens outnumber the weights.
TASKS, LEAST_TASKS = 2, 8
#: The end of a text is a word with this key.
END = -(1 << 63)

_VOCAB = CLASSES * WORDS
_START = _VOCAB + RARE
_CONTEXTS = _START + 1


class Tables(NamedTuple):
    """hashes (ascending) and counts of the frequent words, and each one's place in the vocabulary or -1."""

    hashes: np.ndarray
    counts: np.ndarray
    places: np.ndarray


class Leaves:
    """The tree over the words beyond the vocabulary: a leaf is the first bits of a word's key, a level one more of them."""

    def __init__(self, sizes: np.ndarray) -> None:
        """sizes: tokens and different words of each leaf together."""
        self.bits = len(sizes).bit_length() - 1
        mass = sizes + 1.0
        self.within = np.log10(mass).astype(np.float32)
        # logarithms of the odds of the second way, by node: the root is 1, those below node i are 2 i and 2 i + 1
        self.odds = np.zeros(len(sizes), np.float32)
        for level in reversed(range(self.bits)):
            mass = mass.reshape(-1, 2)
            self.odds[1 << level:2 << level] = np.log(mass[:, 1] / mass[:, 0])
            mass = mass.sum(1)
        depth = np.arange(self.bits)[:, None]
        self.depth, self.inside = depth, depth % LEVELS

    def walk(self, leaf: np.ndarray, words: dict[str, np.ndarray], fine: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By level on the way to the leaves: each feature's weight among the fine ones, the way taken, the odds at the start."""
        before = leaf >> (self.bits - self.depth)
        way = (leaf >> (self.bits - 1 - self.depth)) & 1
        first = self.depth[::LEVELS]
        node = (leaf >> (self.bits - first)) + ((first // LEVELS + 1) << 40)
        widths = np.minimum(LEVELS, self.bits - first[:, 0])
        column = (before & ((1 << self.inside) - 1)) + (1 << self.inside)
        places = np.empty((len(words), *before.shape), np.int64)
        for place, of in zip(places, words.values(), strict=True):
            hashes = _hashed(of, node)
            # a line's nodes in an order of its own: the first ones, used most, fall on all of its weights
            line = _row(hashes, fine * WORDS // LINE) * LINE + (hashes >> np.uint64(60)).astype(np.int64)
            np.bitwise_xor(np.repeat(line, widths, axis=0), column, out=place)
        return places, way, self.odds.take(before + (1 << self.depth), mode="clip")


def leaf_bits(different: int) -> int:
    return max(0, (different // LEAF_WORDS).bit_length() - 1)


def leaf_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def fine_rows(different: int) -> int:
    return max(LEAST_FINE, 1 << (math.ceil(FINE * math.sqrt(different)) - 1).bit_length())


def _shapes(fine: int = 0) -> dict[str, tuple[int, int]]:
    c, s = CLASSES + 1, WORDS
    pairs = PAIRS if not fine else 0
    return {"bias": (1, c), "last": (_CONTEXTS, c), "skip2": (_CONTEXTS, c), "skip3": (_CONTEXTS, c), "pair": (pairs, c),
            "w_bias": (CLASSES, s), "w_last": (_CONTEXTS * CLASSES, s), "w_skip2": (_CONTEXTS * CLASSES, s), "w_pair": (pairs, s)}


def _views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The tables in flat; with more floats than those of a model without fine rows, the fine rows by the steps that use them."""
    fine = 0 if len(flat) == model_size() else (len(flat) - model_size(1) + WORDS) // WORDS
    out, at = {}, 0
    for name, (rows, columns) in _shapes(fine).items():
        out[name] = flat[at:at + rows * columns].reshape(rows, columns)
        at += rows * columns
    if fine:
        shared = flat[len(flat) - fine * WORDS:].reshape(fine, WORDS)
        out |= {f"{step}_{feature}": shared for step in "oi" for feature in ("last", "pair")} | {"tree": shared.reshape(-1)}
    return out


def model_size(fine: int = 0) -> int:
    size = sum(a * b for a, b in _shapes(fine).values())
    return -(-size // GROUP) * GROUP + fine * WORDS if fine else size


def _aligned(flat: np.ndarray) -> np.ndarray:
    """A copy whose lines are those that the processor reads."""
    room = np.empty(len(flat) + LINE, np.float32)
    first = -room.ctypes.data % (4 * LINE) // 4
    room[first:first + len(flat)] = flat
    return room[first:first + len(flat)]


def initial(counts: np.ndarray, rest: float, fine: int = 0) -> np.ndarray:
    """Weights whose shares are those of the counts: counts of the vocabulary by place, and of all other words."""
    flat = np.zeros(model_size(fine), np.float32)
    view = _views(flat)
    known = np.zeros(_VOCAB)
    known[:len(counts)] = counts
    by_class = known.reshape(CLASSES, WORDS)
    view["bias"][0] = np.log(np.append(by_class.sum(1), rest) + 1.0)
    view["w_bias"][:] = np.log(by_class + 1e-3)  # places without a word get next to nothing
    return flat


def _features(p1: np.ndarray, p2: np.ndarray, p3: np.ndarray, cls: np.ndarray) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Rows of the class weights, and of the word weights for tokens of class cls."""
    pair = p1 * 1_000_003 + p2 * 7_919
    inner = pair * 31 + cls * 104_729
    return (_of_classes(p1, p2, p3) | {"pair": (pair ^ (pair >> 11)) % PAIRS}, _of_words(p1, p2, cls) | {"w_pair": (inner ^ (inner >> 9)) % PAIRS})


def _of_classes(p1: np.ndarray, p2: np.ndarray, p3: np.ndarray) -> dict[str, np.ndarray]:
    return {"bias": np.zeros(len(p1), np.int64), "last": p1, "skip2": p2, "skip3": p3}


def _of_words(p1: np.ndarray, p2: np.ndarray, cls: np.ndarray) -> dict[str, np.ndarray]:
    return {"w_bias": cls, "w_last": p1 * CLASSES + cls, "w_skip2": p2 * CLASSES + cls}


def _hashed(words: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Hashes of a feature's words at a node of the factored softmax."""
    h = (words ^ (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _row(hashes: np.ndarray, rows: int) -> np.ndarray:
    return ((hashes >> np.uint64(24)) & np.uint64(rows - 1)).astype(np.int64)


def _fine(step: str, features: dict[str, np.ndarray], node: np.ndarray, rows: int) -> dict[str, np.ndarray]:
    """Fine rows of each feature's words at a node of the factored softmax."""
    return {f"{step}_{name}": _row(_hashed(words, node), rows) for name, words in features.items()}


def _rows(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return table.take(at, axis=0, mode="clip")  # rows are in range; without a check they are copied faster


def _put(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    whole = f"V{rows.strides[0]}"  # a row as one item, which is copied at once
    table.view(whole)[:, 0][at] = rows.view(whole)[:, 0]


def _greatest(rows: np.ndarray) -> np.ndarray:
    """Each row's greatest value as a column, by halves: faster than a maximum along short rows."""
    while (width := rows.shape[1]) > 1:
        rows = np.maximum(rows[:, :(width + 1) // 2], rows[:, width // 2:])
    return rows


def _shares(view: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> np.ndarray:
    logit = None
    for name, at in rows.items():
        if logit is None:
            logit = _rows(view[name], at)
        else:
            logit += _rows(view[name], at)[:, :logit.shape[1]]
    logit -= _greatest(logit)
    np.exp(logit, out=logit)
    logit /= logit @ np.ones((logit.shape[1], 1), np.float32)
    return logit


def _odds(view: dict[str, np.ndarray], at: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Logarithms of the odds of the second way at each level."""
    for weights in at:
        start += view["tree"].take(weights, mode="clip")
    return np.clip(start, -80, 80, out=start)


def _steps(ids: np.ndarray, starts: np.ndarray, keys: np.ndarray | None, leaves: Leaves | None, fine: int) -> Iterator[tuple[slice, list, tuple | None]]:
    """Batches of tokens, the softmax steps that lead to them (the tokens concerned, their rows, the ways taken), and the
    walk down the tree (the tokens concerned, and what Leaves.walk tells).

    keys: of every token's word; without them no word beyond the vocabulary is told apart. fine: number of fine rows.
    """
    p1, p2, p3 = (_back(ids, starts, b, _START) for b in (1, 2, 3))
    if keys is not None:
        k1, k2 = (_back(keys, starts, b, _START).view(np.uint64) for b in (1, 2))
        # mixed once more, so that a feature's rows are not those of another
        words = {"last": k1 * np.uint64(3), "skip2": k2 * np.uint64(5)}
        words["pair"] = (words["last"] ^ (words["last"] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + words["skip2"]
    for f in range(0, len(ids), BATCH):
        s = slice(f, f + BATCH)
        rare = ids[s] >= _VOCAB
        cls = np.where(rare, CLASSES, ids[s] // WORDS)
        known, beyond = np.flatnonzero(~rare), np.flatnonzero(rare)
        c = cls[known]
        if keys is None:
            outer, inner = _features(p1[s], p2[s], p3[s], np.where(rare, 0, cls))
            inner = {k: v[known] for k, v in inner.items()}
        else:
            outer, inner = _of_classes(p1[s], p2[s], p3[s]), _of_words(p1[s][known], p2[s][known], c)
            outer |= _fine("o", {k: words[k][s] for k in ("last", "pair")}, np.zeros(1, np.int64), fine)
            inner |= _fine("i", {k: words[k][s][known] for k in ("last", "pair")}, 1 + c, fine)
        steps = [(np.arange(len(cls)), outer, cls)]
        if len(known):
            steps.append((known, inner, ids[s][known] % WORDS))
        tree = None
        if keys is not None and leaves is not None and leaves.bits and len(beyond):
            tree = (beyond, *leaves.walk(leaf_of(keys[s][beyond], leaves.bits), {k: v[s][beyond] for k, v in words.items()}, fine))
        yield s, steps, tree


def log_shares(view: dict[str, np.ndarray], ids: np.ndarray, starts: np.ndarray, keys: np.ndarray | None = None, leaves: Leaves | None = None) -> np.ndarray:
    """log10 of each token's share given those before it in its text; for a rare token that of its leaf, or of the class of rare words without keys."""
    out = np.zeros(len(ids))
    for s, steps, tree in _steps(ids, starts, keys, leaves, len(view.get("o_last", ()))):
        part = out[s]
        for some, rows, way in steps:
            part[some] += np.log10(np.maximum(_shares(view, rows)[np.arange(len(way)), way], 1e-30))
        if tree is not None:
            some, at, way, start = tree
            odds = _odds(view, at, start)
            odds *= 1 - 2 * way.astype(np.float32)
            part[some] -= np.log(1 + np.exp(odds, out=odds)).sum(0) / math.log(10)
    return out


def _back(tokens: np.ndarray, starts: np.ndarray, back: int, first: int) -> np.ndarray:
    """The token some places back, or first where the text begins later."""
    out = np.full(len(tokens), first, np.int64)
    out[back:] = tokens[:-back]
    for i in range(back):
        at = starts[:-1] + i
        out[at[at < starts[1:]]] = first
    return out


class Trainer:
    """Gradient updates with per-weight rates, from common weights."""

    def __init__(self, flat: np.ndarray, rate: float, leaves: Leaves | None = None) -> None:
        self.flat, self.rate, self.leaves, self.tokens = _aligned(flat), rate, leaves, 0
        self.view, self.seen = _views(self.flat), _views(_aligned(np.ones_like(flat)))
        self.last = np.zeros(max(len(table) for table in self.view.values() if table.ndim == 2), np.int32)

    def _update(self, rows: dict[str, np.ndarray], error: np.ndarray) -> None:
        n, width = error.shape
        here, columns = np.arange(n, dtype=np.int32), np.arange(width)
        for name, at in rows.items():
            size = len(self.view[name])
            if size == 1:
                slope, touched = np.ones((1, n), np.float32) @ error, at[:1]
            elif size <= 1 << 16:
                order = np.argsort(at.astype(np.uint16), kind="stable")  # short keys are sorted by their digits
                ordered = at.take(order)
                heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
                slope, touched = np.add.reduceat(_rows(error, order), heads, axis=0), ordered.take(heads)
            else:
                # the errors of a row, mostly one, are added up where the row comes last
                self.last[at] = here
                to = self.last.take(at, mode="clip")
                own, more = np.flatnonzero(to == here), np.flatnonzero(to != here)
                slope = error.copy()
                np.add.at(slope.reshape(-1), (to.take(more)[:, None] * width + columns).reshape(-1), _rows(error, more).reshape(-1))
                slope, touched = _rows(slope, own), at.take(own)
            seen, weights = _rows(self.seen[name], touched), _rows(self.view[name], touched)
            if seen.shape[1] > width:  # whole rows go faster than parts of them
                slope = np.concatenate([slope, np.zeros((len(slope), seen.shape[1] - width), np.float32)], axis=1)
            seen += slope * slope
            weights += self.rate * slope / np.sqrt(seen)
            _put(self.seen[name], touched, seen)
            _put(self.view[name], touched, weights)

    def _update_tree(self, at: np.ndarray, error: np.ndarray) -> None:
        weights, seen, error = self.view["tree"], self.seen["tree"], error.reshape(-1)
        for places in at.reshape(len(at), -1):
            np.add.at(seen, places, error * error)
            np.add.at(weights, places, self.rate * error / np.sqrt(seen.take(places, mode="clip")))

    def learn(self, ids: np.ndarray, starts: np.ndarray, keys: np.ndarray | None = None) -> None:
        for _, steps, tree in _steps(ids, starts, keys, self.leaves, len(self.view.get("o_last", ()))):
            # all errors first: steps may share fine rows
            errors = []
            for _, rows, way in steps:
                error = -_shares(self.view, rows)
                error[np.arange(len(way)), way] += 1
                errors.append(error)
            if tree is not None:
                _, at, way, start = tree
                wrong = way.astype(np.float32) - 1 / (1 + np.exp(-_odds(self.view, at, start)))
                self._update_tree(at, wrong)
            for (_, rows, _), error in zip(steps, errors, strict=True):
                self._update(rows, error)
            self.tokens += len(steps[0][2])


def _hashes(distinct: pa.LargeBinaryArray) -> np.ndarray:
    """Signed 64-bit keys of words; END stays free."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_numpy(zero_copy_only=False)), np.uint64, len(distinct)).view(np.int64)
    return np.where(h == END, END + 1, h)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the distinct words and of END (last), every token's place among them with each text's end, and bounds."""
    words = words_of(texts, lower=True)
    keys = np.append(_hashes(words.distinct), END)
    codes = np.insert(words.codes.astype(np.int64), words.starts[1:], len(keys) - 1)
    return keys, codes, words.starts + np.arange(len(words.starts))


def _lookup(tables: Tables, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count (-1: not among the frequent words) and vocabulary id of each key; rare words by bucket."""
    if not len(tables.hashes):
        return np.full(len(keys), -1), _VOCAB + keys % RARE
    at = np.minimum(np.searchsorted(tables.hashes, keys), len(tables.hashes) - 1)
    same = tables.hashes[at] == keys
    place = np.where(same, tables.places[at], -1)
    return np.where(same, tables.counts[at], -1), np.where(place >= 0, place, _VOCAB + keys % RARE)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            keys, codes, _ = _tokens(part.column("text"))
            n = np.bincount(codes, minlength=len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n, pa.int64())], ["word", "n"]).filter(pa.array(n > 0))


def _parted(change: np.ndarray, tokens: int) -> tuple[list[bytes], list[bytes]]:
    """Blocks of a task's changes, and the tokens they count for: none where a GROUP of weights is as it was."""
    seen = np.where((change.reshape(-1, GROUP) != 0).any(1), tokens, 0).astype(np.float32)
    cut = range(0, len(change), BLOCK)
    return [change[f:f + BLOCK].tobytes() for f in cut], [seen[f // GROUP:(f + BLOCK) // GROUP].tobytes() for f in cut]


def _averaged(data: list[bytes], seen: list[bytes]) -> tuple[bytes, bytes]:
    """The mean of several changes of a block by their tokens, and the tokens' sums."""
    total, weight = 0.0, 0.0
    for d, n in zip(data, seen, strict=True):
        n = np.frombuffer(n, np.float32).astype(np.float64)
        total = total + np.frombuffer(d, np.float16).astype(np.float64).reshape(-1, GROUP) * n[:, None]
        weight = weight + n
    return (total / np.maximum(weight, 1.0)[:, None]).astype(np.float16).tobytes(), weight.astype(np.float32).tobytes()


def _rounds(texts: DataFrame, held: Broadcast, flat: np.ndarray, rounds: int, rate: float, tasks: int) -> np.ndarray:
    context = texts.sparkSession.sparkContext

    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        data, seen = _averaged(list(rows["data"]), list(rows["seen"]))
        return pd.DataFrame({"block": rows["block"].iloc[:1], "part": rows["part"].iloc[:1] // FAN_IN, "seen": [seen], "data": [data]})

    for r in range(rounds):
        common = context.broadcast(flat)

        def learn(batches: Iterator[pa.RecordBatch], common=common) -> Iterator[pa.RecordBatch]:
            tables, leaves = held.value
            trainer = Trainer(common.value, rate, leaves)
            for batch in batches:
                for part in slices(batch):
                    keys, codes, starts = _tokens(part.column("text"))
                    trainer.learn(_lookup(tables, keys)[1][codes], starts, keys[codes])
            if trainer.tokens:
                change = (trainer.flat - common.value).astype(np.float16)
                parts, seen = _parted(change, trainer.tokens)
                part = [TaskContext.get().partitionId()] * len(parts)
                yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(part, pa.int32()), pa.array(seen, pa.binary()), pa.array(parts, pa.binary())], ["block", "part", "seen", "data"])

        shape = "block int, part int, seen binary, data binary"
        told = texts.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == r).select("text").coalesce(tasks).mapInArrow(learn, shape)
        # a tree of averages: each group holds FAN_IN rows at most
        parts = tasks
        while parts > FAN_IN:
            told = told.withColumn("group", F.floor(F.col("part") / FAN_IN)).groupBy("block", "group").applyInPandas(mean, shape)
            parts = -(-parts // FAN_IN)
        for row in told.groupBy("block").applyInPandas(mean, shape).collect():
            change = np.frombuffer(row["data"], np.float16).astype(np.float32)
            flat[row["block"] * BLOCK:row["block"] * BLOCK + len(change)] += change
        common.destroy()
    return flat


def score(docs: DataFrame, fold: Column, rounds: int = ROUNDS, rate: float = RATE, frequent: int = FREQUENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Scores of every whole text after learning from the rows that fold marks (null: not marked).

    Returns doc_id, n_tokens, n_known, train_tokens, base_score, score; scores are log10 probabilities of the text and
    its end, base_score by add-one unigram shares. A null or empty text is its end alone. Repeated rows are rows of their
    own. With nothing to learn from, counts are 0 and the model's shares are even. Other columns are left out.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"), F.coalesce(fold, F.lit(False)).alias("_train"))
    train = texts.filter("_train").select(F.coalesce("text", F.lit("")).alias("text"))
    counts = settle(train.mapInArrow(_counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    row = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, different = row["n"] or 0, row["v"]
    top = counts.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    word, n = top.column("word").to_numpy(), top.column("n").to_numpy()
    rank = np.lexsort((word, -n))
    places = np.full(len(word), -1, np.int64)
    places[rank[:_VOCAB]] = np.arange(min(_VOCAB, len(word)))
    vocabulary = n[rank[:_VOCAB]]
    by_hash = np.argsort(word)
    tables = Tables(word[by_hash], n[by_hash], places[by_hash])
    rest_n, rest_v = total - int(vocabulary.sum()), different - len(vocabulary)
    bits = leaf_bits(rest_v)
    leaf = F.shiftrightunsigned("word", 64 - bits) if bits else F.lit(0).cast("long")
    below = counts.groupBy(leaf.alias("leaf")).agg((F.sum("n") + F.count(F.lit(1))).alias("n")).toArrow()
    sizes = np.zeros(1 << bits, np.int64)
    sizes[below.column("leaf").to_numpy()] = below.column("n").to_numpy()
    np.subtract.at(sizes, leaf_of(word[rank[:_VOCAB]], bits), vocabulary + 1)
    leaves = Leaves(sizes)
    flat = initial(vocabulary, float(rest_n), fine_rows(different))
    held = spark.sparkContext.broadcast((tables, leaves))
    flat = _rounds(train, held, flat, rounds, rate, max(LEAST_TASKS, TASKS * total // len(flat)))
    learnt = spark.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, leaves = held.value
        view, row = _views(_aligned(learnt.value)), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch):
                keys, codes, starts = _tokens(part.column("text"))
                count, place = _lookup(tables, keys)
                rare = place >= _VOCAB
                logs = np.log10(np.maximum(count, 0) + 1.0)
                ids, words, known = place[codes], keys[codes], (count >= 0)[codes]
                shares = log_shares(view, ids, starts, keys=words, leaves=leaves)
                shares -= np.where(rare, leaves.within[leaf_of(keys, leaves.bits)], 0.0)[codes]
                add = lambda x: np.add.reduceat(x.astype(float), starts[:-1])  # noqa: E731  every text has its end
                text = np.repeat(np.arange(part.num_rows), np.diff(starts))[~known]
                beyond = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)), pa.int32()), pa.array(words[~known]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(part.num_rows)), part.column(0), pa.array(np.diff(starts), pa.int64()), pa.array(add(known).astype(np.int64)),
                    pa.array(add(logs[codes])), pa.array(add(np.where(rare, logs, 0.0)[codes])), pa.array(add(shares)), beyond,
                ], ["row", "doc_id", "n_tokens", "n_known", "logs", "rare_logs", "shares", "beyond"])
                row += part.num_rows

    kind = docs.schema[id_column].dataType.simpleString()
    scored = settle(texts.select("doc_id", "text").mapInArrow(run, f"row bigint, doc_id {kind}, n_tokens bigint, n_known bigint, logs double, rare_logs double, shares double, beyond array<bigint>"), "scored")
    # tokens that aren't frequent words: their counts by a join; all of them are rare
    beyond = scored.select("row", F.explode("beyond").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("times"))
    more = beyond.join(counts, "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"), F.sum("times").alias("more_known"))
    all_logs = F.coalesce("more_logs", F.lit(0.0))
    return (scored.drop("beyond").join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + all_logs - F.col("n_tokens") * F.lit(float(np.log10(total + different + 1.0)))).alias("base_score"),
        (F.col("shares") + F.col("rare_logs") + all_logs).alias("score")))
