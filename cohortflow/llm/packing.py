"""Pack documents into sequences of one window by non-negative least squares over a histogram of lengths.

Whole windows of a document are sequences of their own. What is left of each document is one piece shorter than a
window; the pieces' histogram has fewer bins than the window has tokens, however many documents there are. Combinations
of at most three lengths that fill a window closely are enumerated, their repeat counts are solved by non-negative least
squares against the histogram, rounded down, and the pieces that remain are packed greedily, longest first. The plan (so
many sequences of these lengths) is turned into places by each piece's rank among those of its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortflow.llm.shipping import bound_batches, ship_package
from cohortflow.llm.tokens import library_encoder
from cohortflow.llm.words import parts
from cohortflow.operators.ranking import number_rows
from cohortflow.session import settle

#: Third members tried for every pair of lengths, and how far below the window a combination may stay.
THIRDS, SLACK = 12, 2
SWEEPS = 60
#: Bytes of text that are encoded at once.
IDS_BYTES = 2 << 20

PIECES = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")])


class Run(NamedTuple):
    """count sequences of the same lengths, in this order."""

    lengths: tuple[int, ...]
    count: int


def combinations(present: np.ndarray, window: int, thirds: int = THIRDS, slack: int = SLACK) -> list[tuple[int, ...]]:
    """Up to three of the present lengths, longest first, that sum to window - slack .. window.

    Every length gets its pairs, and triples whose other two are spread over the lengths that fit.
    """
    have = np.zeros(window + 1, bool)
    have[present] = True
    out: dict[tuple[int, ...], None] = {}
    for a in map(int, present):
        for total in range(window, window - slack - 1, -1):
            rest = total - a
            if rest == 0:
                out[(a,)] = None
            if rest > 0 and have[rest]:
                out[tuple(sorted((a, rest), reverse=True))] = None
        second = present[present < window - a]
        second = second[have[window - a - second]]
        if len(second):
            for b in map(int, second[np.linspace(0, len(second) - 1, min(thirds, len(second))).astype(int)]):
                out[tuple(sorted((a, b, window - a - b), reverse=True))] = None
    return list(out)


def least_squares(patterns: list[tuple[int, ...]], counts: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Repeat counts x >= 0 that bring the patterns' use of each length near its count: accelerated projected gradient."""
    if not patterns:
        return np.zeros(0)
    rows = np.concatenate([np.array(p, np.int64) for p in patterns])
    cols = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    use = lambda x: np.bincount(rows, weights=x[cols], minlength=len(counts))
    back = lambda r: np.bincount(cols, weights=r[rows], minlength=len(patterns))
    weight = 1.0 / np.maximum(counts, 1.0)  # misses count in proportion to a length's pieces
    v = np.ones(len(patterns))
    for _ in range(12):
        v = back(weight * use(v))
        top = np.linalg.norm(v)
        v /= top
    step, x = 1.0 / (1.1 * top), np.zeros(len(patterns))
    y, t = x.copy(), 1.0
    for _ in range(sweeps):
        after = np.maximum(0.0, y - step * back(weight * (use(y) - counts)))
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = after + (t - 1) / s * (after - x), after, s
    return x


def plan(counts: np.ndarray, window: int) -> list[Run]:
    """Sequences that use each length exactly as often as counts says; counts[n]: pieces of n tokens, 1 to window."""
    left = np.asarray(counts, np.int64).copy()
    runs: list[Run] = []
    if left[window]:
        runs.append(Run((window,), int(left[window])))
        left[window] = 0
    present = np.flatnonzero(left)
    patterns = combinations(present, window)
    wanted = np.floor(least_squares(patterns, left.astype(float))).astype(np.int64)
    for k in np.argsort(-wanted, kind="stable"):
        if wanted[k] <= 0:
            break
        lengths, times = np.unique(patterns[k], return_counts=True)
        n = int(min(wanted[k], (left[lengths] // times).min()))
        if n > 0:
            left[lengths] -= n * times
            runs.append(Run(patterns[k], n))
    runs += _greedy(left, window)
    return runs


def _greedy(left: np.ndarray, window: int) -> list[Run]:
    """Longest piece first, then the longest that still fits, as long as one does; equal sequences at once."""
    runs = []
    while (present := np.flatnonzero(left)).size:
        room, taken = window, {}
        while room and (k := int(np.searchsorted(present, room, side="right"))):
            n = int(present[k - 1])
            while n and taken.get(n, 0) >= left[n]:
                k -= 1
                n = int(present[k - 1]) if k else 0
            if not n:
                break
            fits = min(room // n, int(left[n]) - taken.get(n, 0))
            taken[n] = taken.get(n, 0) + fits
            room -= fits * n
        count = min(int(left[n]) // k for n, k in taken.items())
        for n, k in taken.items():
            left[n] -= k * count
        runs.append(Run(tuple(n for n, k in taken.items() for _ in range(k)), count))
    return runs


def places(runs: list[Run]) -> dict[str, np.ndarray]:
    """Where the pieces of a length go: from rank `rank` on (0 first), into sequences from `sequence` on at `offset`."""
    lengths = np.array([n for r in runs for n in r.lengths], np.int64)
    counts = np.array([r.count for r in runs for _ in r.lengths], np.int64)
    heads = np.concatenate(([0], np.cumsum([r.count for r in runs])))[:-1] if runs else np.zeros(0, np.int64)
    sequence = np.array([h for h, r in zip(heads, runs, strict=True) for _ in r.lengths], np.int64)
    offset = np.array([sum(r.lengths[:i]) for r in runs for i in range(len(r.lengths))], np.int64)
    order = np.argsort(lengths, kind="stable")
    lengths, counts, sequence, offset = lengths[order], counts[order], sequence[order], offset[order]
    upto = np.cumsum(counts) - counts
    first = np.concatenate(([True], lengths[1:] != lengths[:-1])) if len(lengths) else np.zeros(0, bool)
    rank = upto - np.maximum.accumulate(np.where(first, upto, 0)) if len(lengths) else upto
    return {"length": lengths, "rank": rank, "sequence": sequence, "offset": offset}


def _pieces(path: str, end_id: int, window: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path, False)
        for part in parts(batches, most=IDS_BYTES):
            flat, bounds = encoder.encode(part.column("text"))
            sizes = np.diff(bounds) + 1
            ids = np.insert(flat, bounds[1:], end_id).astype("<u4")  # the end of each document
            begins = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            n = -(-sizes // window)
            row = np.repeat(np.arange(len(sizes)), n)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * window
            length = np.minimum(window, sizes[row] - start)
            crcs = [crc32(ids[a:a + k]) for a, k in zip((begins[row] + start).tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (start, length, crcs, sizes[row]))], names)
        encoder.empty()  # the worker goes on to other work with what it keeps; the next texts bring other words

    return run


def cut(docs: DataFrame, path: str, end_id: int, window: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of each document and end_id, cut at every window: id, start, length, ids_crc32, doc_tokens per piece."""
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_column].dataType), *PIECES])
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(_pieces(path, end_id, window, schema.names), schema)


def pack(docs: DataFrame, path: str, end_id: int = 2, window: int = 4096, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's ids, end_id included, in sequences of at most `window` tokens.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty text is a piece
    of the end id alone. Repeated rows are pieces of their own. No documents: no rows. Other columns are left out.
    The driver sees the histogram only, at most `window` numbers.
    """
    pieces = settle(cut(docs, path, end_id, window, id_column, text_column), "pieces")
    counts = np.zeros(window + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    where = places(plan(counts, window))
    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    #: A rank and a length as one number; ranks stay below 2 ** 48 and lengths below 2 ** 15 here.
    keys = where["length"] << 48 | where["rank"]
    table = docs.sparkSession.sparkContext.broadcast((keys, where["sequence"] - where["rank"], where["offset"]))

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, shift, offset = table.value
        for f in frames:
            rank = f.pop("_rank").to_numpy() - 1
            at = np.searchsorted(keys, f["length"].to_numpy() << 48 | rank, side="right") - 1
            yield f.assign(sequence_id=shift[at] + rank, offset=offset[at])

    ranked = number_rows(pieces, [F.col("doc_id"), F.col("start"), F.col("ids_crc32")], ["length"], "_rank")
    return ranked.mapInPandas(put, schema)
