"""Toxicity by a subsequence string kernel, Nystroem landmarks and a support vector machine.

Two words are compared by the subsequences of three letters they share, each weighted down by the gaps it spans; punctuation
inside a word and blanks between single letters are taken out first. The kernel is multiplied by the share of the landmark's
subsequences that the word holds, so that an insult with letters put in, which holds them all, is nearer than a fragment of it.
Landmarks are words, or the first letters of words, that labelled toxic texts hold far more often than clean ones. A text's
kernel with a landmark is the greatest over its words, less what clean texts reach by their length. A support vector machine
in the landmarks' span, its norm taken by the landmarks' own kernel matrix, gives each landmark a weight of 0 or more: no
insult speaks for a text. Its margin is calibrated to 0..1 on whole labelled texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortflow.llm.linear import calibrated, sigmoid
from cohortflow.llm.shipping import bound_batches, ship_package
from cohortflow.llm.words import parts, words_of
from cohortflow.session import settle

#: Labelled texts per class that the model is fitted on; the bound of what it learns from.
PER_CLASS = 5000
LANDMARKS = 64
#: In small samples: share of the clearest word's evidence that a landmark needs, and what it needs at least.
CLEAR, LEAST_EVIDENCE = 0.6, 10.8
#: Share of its labelled texts that must be toxic before a landmark alone makes a sentence an example of toxicity.
ALONE = 0.85
#: First letters of a word that may be a landmark.
STEMS = (5, 6, 7, 8)
#: A word nearer than this to a chosen landmark is none itself.
ALIKE = 0.35
#: Letters a subsequence may span, and the weight of each letter of the span.
SPAN, DECAY = 8, 0.8
#: Similarities below FLOOR count as none.
FLOOR = 0.08
#: What clean texts reach: this quantile of them, but at most MOST_USUAL.
USUAL, MOST_USUAL = 0.995, 0.35
#: Subsequences that are compared at once, and bytes of text.
AT_ONCE, TEXT_BYTES = 1 << 15, 4 << 20
#: How much more clean rows weigh than toxic ones, so that landmarks which clean texts also reach weigh little.
AGAINST = 20.0
#: Share of clean labelled texts that may score 0.5 and more, and the least slope of the score there.
FALSE_SHARE, LEAST_SLOPE = 0.015, 6.0
#: Letters put into landmarks for examples, and the shortest landmarks that get some.
GAPS, LEAST_GAPPED = 2, 5
#: Characters that aren't part of a word at its ends.
MARKS = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
SENTENCE_END = re.compile(r"[.!?\n]+")
#: Longer words are compared in overlapping windows of this many bytes.
LONGEST = 24
ALPHABET = 32


class Model(NamedTuple):
    landmarks: list[bytes]
    usual: np.ndarray
    weights: np.ndarray
    intercept: float
    slope: float
    shift: float


def _symbols() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[128:] = 27 + np.arange(128) % 5
    table[ord("0"):ord("9") + 1] = 27 + np.arange(10) % 5
    table[ord("a"):ord("z") + 1] = np.arange(1, 27)
    return table


#: Bytes to symbols; 0: left out.
SYMBOLS = _symbols()


@lru_cache(maxsize=64)
def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all subsequences within the span, and their weights."""
    found = [t for t in combinations(range(length), 3) if t[2] - t[0] < SPAN]
    at = np.array(found, np.int64).reshape(-1, 3)
    return at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)


def _features(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """words: symbols, one row each, all of one length. Subsequences (row, ascending) and unit-length weights (0: a repeat)."""
    at, weight = _triples(words.shape[1])
    code = (words[:, at[:, 0]] * ALPHABET + words[:, at[:, 1]]) * ALPHABET + words[:, at[:, 2]]
    order = np.argsort(code, axis=1)
    code = np.take_along_axis(code, order, 1)
    value = weight[order]
    upto = np.cumsum(value, axis=1)
    last = np.ones(code.shape, bool)
    last[:, :-1] = code[:, 1:] != code[:, :-1]
    before = np.maximum.accumulate(np.where(last, upto, 0.0), axis=1)
    earlier = np.concatenate([np.zeros((len(code), 1)), before[:, :-1]], axis=1)
    value = np.where(last, upto - earlier, 0.0)
    return code, value / np.sqrt((value * value).sum(1, keepdims=True))


def _spelled(words: list[bytes]) -> list[np.ndarray]:
    out = []
    for w in words:
        s = SYMBOLS[np.frombuffer(w, np.uint8)]
        out.append(s[s > 0])
    return out


class Similarity:
    """Of many words with the landmarks."""

    def __init__(self, landmarks: list[bytes]) -> None:
        self.m = len(landmarks)
        self.table = np.zeros((ALPHABET ** 3, self.m), np.float32)
        for k, s in enumerate(_spelled(landmarks)):
            if len(s) >= 3:
                code, value = _features(s[None, :LONGEST])
                self.table[code[0], k] += value[0]
        self.active = (self.table != 0).any(1)
        self.share = self.table / np.maximum(self.table.sum(0), 1e-9)

    def hits(self, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """flat: symbols of all words in a row. The words with a similarity of FLOOR or more, and theirs with each landmark."""
        size = np.diff(starts)
        parts = np.maximum(1, -(-(size - LONGEST) // (LONGEST // 2)) + 1)
        word = np.repeat(np.arange(len(size)), parts)
        step = (np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts)) * (LONGEST // 2)
        begin = starts[:-1][word] + step
        width = np.minimum(size[word] - step, LONGEST)
        found, values = [], []
        for length in range(3, LONGEST + 1):
            rows = np.flatnonzero(width == length)
            step = max(1, AT_ONCE // len(_triples(length)[0]))
            for first in range(0, len(rows), 8 * step):
                some = rows[first:first + 8 * step]
                code, value = _features(flat[begin[some][:, None] + np.arange(length)])
                near = ((value * value) * self.active[code]).sum(1) >= FLOOR * FLOOR  # no landmark can be nearer than this
                if near.any():
                    some, code, value = some[near], code[near], value[near]
                    for f in range(0, len(some), step):
                        codes = code[f:f + step]
                        k = np.matmul(value[f:f + step, None, :].astype(np.float32), self.table[codes])[:, 0]
                        hit = np.flatnonzero((k >= FLOOR).any(1))
                        if len(hit):
                            here = (value[f:f + step][hit] > 0)[:, None, :].astype(np.float32)
                            k = np.minimum(k[hit], 1.0) * np.minimum(np.matmul(here, self.share[codes[hit]])[:, 0], 1.0)
                            found.append(word[some[f:f + step][hit]])
                            values.append(k)
        if not found:
            return np.zeros(0, np.int64), np.zeros((0, self.m), np.float32)
        k, word = np.concatenate(values), np.concatenate(found)
        some = (k >= FLOOR).any(1)
        return word[some], np.where(k[some] >= FLOOR, k[some], 0.0).astype(np.float32)

    def own(self, landmarks: list[bytes]) -> np.ndarray:
        return _words_alone(self, landmarks)

    def texts(self, column: pa.Array) -> np.ndarray:
        """Greatest similarity of each text's words with each landmark."""
        words = words_of(column, lower=True)
        _, offsets, data = words.distinct.buffers()
        n = len(words.distinct)
        bounds = np.frombuffer(offsets, np.int64, n + 1)
        symbols = SYMBOLS[np.frombuffer(data, np.uint8)[:bounds[-1]]] if n else np.zeros(0, np.int64)
        used = symbols > 0
        starts = np.concatenate(([0], np.cumsum(used)))[bounds]
        flat, size = symbols[used], np.diff(starts)
        text = np.repeat(np.arange(len(column)), np.diff(words.starts))
        # runs of three and more single letters are words of their own
        single = size[words.codes] == 1 if n else np.zeros(0, bool)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], single.astype(np.int8), [0]))))
        first, last = edge[::2], edge[1::2]
        run = np.concatenate([np.zeros(0, np.int64), *[np.arange(a, b) for a, b in zip(first, last, strict=True) if b - a >= 3]]).astype(np.int64)
        ends = np.flatnonzero(np.append((np.diff(run) > 1) | (np.diff(text[run]) > 0), True)) + 1 if len(run) else np.zeros(0, np.int64)
        flat = np.concatenate([flat, flat[starts[:-1][words.codes[run]]]]) if len(run) else flat
        starts = np.concatenate([starts, starts[-1] + ends])
        codes = np.concatenate([words.codes, n + np.arange(len(ends))])
        text = np.concatenate([text, text[run[ends - 1]] if len(run) else text[:0]])
        out = np.zeros((len(column), self.m), np.float32)
        rows, values = self.hits(flat, starts)
        if len(rows):
            best = np.full(len(starts) - 1, -1, np.int64)
            kept = np.unique(rows)
            best[kept] = np.arange(len(kept))
            pooled = np.zeros((len(kept), self.m), np.float32)
            np.maximum.at(pooled, best[rows], values)
            at = np.flatnonzero(best[codes] >= 0)
            for first in range(0, len(at), AT_ONCE):
                some = at[first:first + AT_ONCE]
                np.maximum.at(out, text[some], pooled[best[codes[some]]])
        return out


def _words_alone(similarity: Similarity, words: list[bytes]) -> np.ndarray:
    """Similarities of single words with the landmarks."""
    spelled = _spelled(words)
    flat = np.concatenate(spelled) if spelled else np.zeros(0, np.int64)
    rows, values = similarity.hits(flat, np.concatenate(([0], np.cumsum([len(s) for s in spelled]))).astype(np.int64))
    out = np.zeros((len(words), similarity.m))
    np.maximum.at(out, rows, values)
    return out


def _gapped(word: bytes) -> list[bytes]:
    """word with one letter put in at a few places, and with two up to GAPS letters between others."""
    n = len(word)
    places = {(i,) for i in (n // 3, n // 2, 2 * n // 3)}
    for gaps in range(2, GAPS + 1):
        for first in (1, 2):  # side by side from there on, and spread over the word
            places.add(tuple(range(first, first + gaps)))
            places.add(tuple(sorted({first + k * (n - 1 - first) // (gaps - 1) for k in range(gaps)})))
    out = []
    for at in sorted(places):
        if at[-1] < n:
            bounds = [0, *at, n]
            out.append(b"x".join(word[a:b] for a, b in zip(bounds, bounds[1:])))
    return out


def _sample(labels: DataFrame, fold: Column, per_class: int) -> DataFrame:
    """doc_id and toxic of at most per_class labelled ids of each class, chosen by a hash of the id."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & fold).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return known.filter("toxic = 1").orderBy(*order).limit(per_class).unionByName(known.filter("toxic = 0").orderBy(*order).limit(per_class))


def _stems(word: bytes) -> set[bytes]:
    """The word without marks at its ends, and its first letters where it is longer than they are."""
    letters = word.decode(errors="ignore").strip(MARKS)
    word = letters.encode()
    return {word, *(letters[:n].encode() for n in STEMS if len(letters) > n)}


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean texts hold each word, and each word that begins so."""
    for part in parts(batches):
        words = words_of(part.column("text"), lower=True)
        stems = [sorted(_stems(w)) for w in words.distinct.to_pylist()]
        units = pa.array([x for some in stems for x in some], pa.large_binary()).dictionary_encode()
        of = units.indices.to_numpy(zero_copy_only=False)
        begins = np.concatenate(([0], np.cumsum([len(x) for x in stems]))).astype(np.int64)
        n = max(len(units.dictionary), 1)
        text = np.repeat(np.arange(part.num_rows), np.diff(words.starts))
        size = np.diff(begins)[words.codes]
        at = np.repeat(begins[words.codes], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        pair = np.unique(np.repeat(text, size) * n + of[at])
        toxic = part.column("toxic").to_numpy(zero_copy_only=False)[pair // n] == 1
        code = pair % n
        yield pa.RecordBatch.from_arrays([units.dictionary.cast(pa.binary()), *(pa.array(np.bincount(code[which], minlength=n)[:len(units.dictionary)]) for which in (toxic, ~toxic))], ["word", "toxic", "clean"])


def _evidence(words: int) -> float:
    """Twice the log likelihood ratio that chance alone gives to about one of so many words."""
    many = np.log(max(words, 100))
    return float(2 * many - np.log(np.pi * many))


def _apart(words: list[bytes], most: int) -> list[int]:
    """Places of words, the first ones first, that aren't spellings of an earlier one; each with three letters or more."""
    kept: list[int] = []
    vectors: list[dict[int, float]] = []
    for i, s in enumerate(_spelled(words)):
        if len(s) < 3:
            continue
        code, value = _features(s[None, :LONGEST])
        mine = {c: v for c, v in zip(code[0].tolist(), value[0].tolist(), strict=True) if v > 0}
        if all(sum(v * other.get(c, 0.0) for c, v in mine.items()) < ALIKE for other in vectors):
            kept.append(i)
            vectors.append(mine)
            if len(kept) == most:
                break
    return kept


def _machine(x: np.ndarray, positive: np.ndarray, own: np.ndarray, c: float = 1000.0, rounds: int = 3000) -> tuple[np.ndarray, float]:
    """Weights >= 0 and intercept that minimise weights' kernel norm / 2 + c * mean squared hinge, classes weighted alike but for AGAINST.

    Accelerated projected gradient steps.
    """
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / positive.sum(), 0.5 * AGAINST / (~positive).sum()) * c
    rows = np.column_stack([x, np.ones(len(x))])
    norm = np.zeros((x.shape[1] + 1,) * 2)
    norm[:-1, :-1] = own
    step = 1.0 / (np.linalg.eigvalsh(norm + (rows * share[:, None]).T @ rows).max() + 1e-9)
    a, ahead, t = np.zeros(rows.shape[1]), np.zeros(rows.shape[1]), 1.0
    for _ in range(rounds):
        gap = np.maximum(0.0, 1 - y * (rows @ ahead))
        after = ahead - step * (norm @ ahead - rows.T @ (share * y * gap))
        after[:-1] = np.maximum(0.0, after[:-1])
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, a, t = after + (t - 1) / s * (after - a), after, s
    return a[:-1], float(a[-1])


def fit(docs: DataFrame, labels: DataFrame, fold: Column | None = None, per_class: int = PER_CLASS, landmarks: int = LANDMARKS) -> Model | None:
    """Learn from the labelled texts that fold marks; docs: doc_id, text; labels: doc_id, toxic (1 or 0, else unlabelled).

    Sentences are examples beside the texts: those of toxic texts that hold a landmark whose texts are mostly toxic, so that
    one insult is enough, and those of clean texts; so are these landmarks with one and two letters put in.
    The sample is bounded by per_class texts of each class. Repeated labels of an id: toxic if any is. None if the
    sample lacks one of the classes or no word has enough evidence.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    sample = _sample(labels, F.lit(True) if fold is None else fold, per_class)
    train = settle(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id").select("text", "toxic"), "labelled")
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    counts = train.mapInArrow(_word_counts, "word binary, toxic bigint, clean bigint").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = settle(counts, "words")
    # likelihood ratio of a word's share of toxic texts against that of all texts
    share = sizes[1] / (sizes[1] + sizes[0])
    total = F.col("toxic") + F.col("clean")
    part = lambda c, q: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (total * q))).otherwise(0.0)
    told = counts.withColumn("g", 2 * (part("toxic", share) + part("clean", 1 - share))).filter((F.col("toxic") > share * total) & (F.octet_length("word") >= 3))
    # in a small sample even the clearest words have little evidence
    evidence = min(_evidence(counts.count()), max(LEAST_EVIDENCE, CLEAR * (told.agg(F.max("g")).first()[0] or 0.0)))
    told = told.filter(F.col("g") >= evidence)
    rows = told.orderBy(F.desc("g"), F.octet_length("word").desc(), "word").limit(8 * landmarks).collect()
    kept = [rows[i] for i in _apart([bytes(r["word"]) for r in rows], landmarks)]
    marks = [bytes(r["word"]) for r in kept]
    if not marks:
        return None
    alone = np.array([r["toxic"] >= ALONE * (r["toxic"] + r["clean"]) for r in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        similarity = Similarity(marks)
        for part in parts(batches, most=TEXT_BYTES):
            k = [r.tobytes() for r in similarity.texts(part.column("text"))]
            toxic = part.column("toxic").to_pylist()
            said = [(t, s) for t, x in zip(toxic, part.column("text").to_pylist(), strict=True) if x for s in SENTENCE_END.split(x) if s]
            values = similarity.texts(pa.array([s for _, s in said], pa.string()))
            kind = np.array([t for t, _ in said])
            insults = {r.tobytes() for r in values[(kind == 1) & ((values > 0.999) & alone).any(1)]} if len(said) else set()
            plain = {r.tobytes() for r in values[kind == 0]} if len(said) else set()
            yield pa.RecordBatch.from_arrays([pa.array(toxic + [3] * len(insults) + [2] * len(plain), pa.int32()), pa.array(k + sorted(insults) + sorted(plain), pa.binary())], ["toxic", "k"])

    found = train.mapInArrow(run, "toxic int, k binary").toArrow()
    k = np.stack([np.frombuffer(v.as_buffer(), np.float32) for v in found.column("k")])
    kind = found.column("toxic").to_numpy()
    del found
    clean = k[kind == 0]
    usual = np.minimum(np.quantile(clean, USUAL, axis=0), MOST_USUAL)
    similarity = Similarity(marks)
    own = _above(similarity.own(marks), usual)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    own = (vectors * np.maximum(values, 1e-3 * values.max())) @ vectors.T
    gapped = [g for m, yes in zip(marks, alone, strict=True) if yes and len(m) >= LEAST_GAPPED for g in _gapped(m)]
    x = _above(np.concatenate([k, _words_alone(similarity, gapped)]), usual)
    positive = np.append(kind % 2 == 1, np.ones(len(gapped), bool))
    w, b = _machine(x, positive, own)
    texts = kind < 2
    margin = x[:len(kind)][texts] @ w + b
    slope = max(calibrated(margin, kind[texts] == 1)[0], LEAST_SLOPE)
    # 0.5 lies where few clean texts are above, and above a text without anything near a landmark
    border = max(float(np.quantile(margin[kind[texts] == 0], 1 - FALSE_SHARE)), b + (0.25 * -b if b < 0 else 0.25))
    return Model(marks, usual, w, b, slope, -slope * border)


def _above(k: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Similarities as far as they are above what clean texts reach, 0 to 1."""
    return np.maximum(0.0, k - usual) / (1 - usual)


def score(docs: DataFrame, model: Model | None, text_column: str = "text", into: str = "toxicity") -> DataFrame:
    """docs with the column `into` (double, 0 to 1) behind its columns; every whole text is read.

    Rows and other columns stay as they are; a column of docs named like `into` is replaced. A null or empty text has the score of
    a text without any word near a landmark. Without a model every score is 0.
    """
    docs = docs.drop(into)
    if model is None:
        return docs.withColumn(into, F.lit(0.0))
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())])
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        similarity = Similarity(model.landmarks)
        for part in parts(batches, text_column, TEXT_BYTES):
            margin = _above(similarity.texts(part.column(text_column).cast(pa.string())), model.usual) @ model.weights + model.intercept
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sigmoid(model.slope * margin + model.shift))], names)

    return docs.mapInArrow(run, schema)
