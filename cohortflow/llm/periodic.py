"""Periodic runs of words: a suffix automaton whose link tree is accessed as a link-cut tree.

A run is a longest stretch of consecutive words with smallest period q. Every appended word accesses the path from its
prefix's state to the root. The path falls into segments of one colour, the last place at which a segment's suffixes
ended; the access gives all of them the new place. A segment whose longest suffix ends `distance` words earlier and is
at least as long as this distance is a square: the words from the earlier place's suffix on have the smallest period
`distance`. The segment's length is the whole common suffix, so the square's stretch begins where the run begins; as long
as the following words give the same distance, the run goes on.

A run has at least `exponent` periods, so each of its three-word passages occurs often in it. Places whose passage is
rarer than that are no part of a run; texts are first taken apart there, again and again until nothing changes, and the
automaton takes the stretches that are left, one at a time. This leaves out no run and cuts none short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortflow.llm.shipping import ship_package
from cohortflow.llm.words import joined, slices, words_of

#: Bytes of text whose words are held at once; a longer text goes alone.
SLICE_BYTES = 4 << 20
#: Words of a passage that is counted before the automaton is built.
PASSAGE = 3

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "period", "length")])


class Automaton:
    """The suffix automaton of a list of numbers: len and link of its states (root 1, 0 is none), the state of each prefix."""

    def __init__(self, symbols: list[int]) -> None:
        self.size, self.link, self.prefix = [0, 0], [0, 0], []
        size, link, steps, last = self.size, self.link, [{}, {}], 1
        for c in symbols:
            state = len(size)
            size.append(size[last] + 1)
            link.append(1)
            steps.append({})
            at = last
            while at and c not in steps[at]:
                steps[at][c] = state
                at = link[at]
            if at:
                onto = steps[at][c]
                if size[onto] != size[at] + 1:
                    copy = len(size)
                    size.append(size[at] + 1)
                    link.append(link[onto])
                    steps.append(steps[onto].copy())
                    link[onto] = copy
                    while at and steps[at].get(c) == onto:
                        steps[at][c] = copy
                        at = link[at]
                    onto = copy
                link[state] = onto
            self.prefix.append(state)
            last = state


class LastPlaces:
    """The link tree cut into paths of one colour, each a splay tree ordered by depth; the colour lies at its root."""

    def __init__(self, parents: list[int]) -> None:
        n = len(parents)
        self.up, self.left, self.right, self.colour = list(parents), [0] * n, [0] * n, [-1] * n

    def _lift(self, x: int) -> int:
        """Rotate x over its parent in its splay tree and return that parent."""
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = right[x]
            left[p], right[x] = b, p
        else:
            b = left[x]
            right[p], left[x] = b, p
        if b:
            up[b] = p
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        up[p], up[x] = x, g
        return p

    def splay(self, x: int) -> None:
        """Make x the root of its splay tree and give it the tree's colour."""
        up, left, right = self.up, self.left, self.right
        top = x
        while (p := up[x]) and (left[p] == x or right[p] == x):
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                top = g
                self._lift(p if (left[g] == p) == (left[p] == x) else x)
            else:
                top = p
            self._lift(x)
        if top != x:
            self.colour[x] = self.colour[top]

    def access(self, state: int, place: int) -> list[tuple[int, int]]:
        """(earlier place, deepest state) of each segment on the way to the root, all of which get the new place."""
        up, right, colour, met = self.up, self.right, self.colour, []
        x, below = state, 0
        while x:
            if (p := up[x]) and (self.left[p] == x or right[p] == x) or self.left[x] or right[x]:
                self.splay(x)
            met.append((colour[x], x))
            if right[x]:
                colour[right[x]] = colour[x]  # the lower part keeps its place
            right[x] = below
            below, x = x, up[x]
        colour[below] = place
        return met


def runs_of(symbols: list[int], exponent: int = 2, least: int = 2) -> list[tuple[int, int, int]]:
    """(start, period, length) of all runs with length >= max(least, exponent * period), by start and period; exponent 2 or more."""
    made = Automaton(symbols)
    places, size = LastPlaces(made.link), made.size
    last: dict[tuple[int, int], int] = {}
    for i, state in enumerate(made.prefix):
        for earlier, deepest in places.access(state, i):
            period = i - earlier
            if earlier >= 0 and size[deepest] >= (exponent - 1) * period:
                last[earlier - size[deepest] + 1, period] = i
    return sorted((s, q, i - s + 1) for (s, q), i in last.items() if i - s + 1 >= max(least, exponent * q))


def least_copies(exponent: int, least: int, passage: int = PASSAGE) -> int:
    """How often every passage of a run occurs in it, at least."""
    return min((max(least, exponent * q) - passage + 1) // q for q in range(1, passage + 1))


def dense_stretches(codes: np.ndarray, starts: np.ndarray, copies: int, passage: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of stretches in which every passage occurs `copies` times or more; starts: texts' first words and the end."""
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    at = np.arange(len(codes) - passage + 1) if len(codes) >= passage else np.zeros(0, np.int64)
    at = at[text[at] == text[at + passage - 1]]
    mixed = np.zeros(len(at), np.uint64)
    for k in range(passage):  # equal passages get equal numbers; others seldom do, which only keeps more
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[at + k].astype(np.uint64)
        mixed ^= mixed >> np.uint64(29)
    group = text[at].astype(np.uint64)
    while len(at):
        _, which, counts = np.unique(mixed + group * np.uint64(0xD6E8FEB86659FD93), return_inverse=True, return_counts=True)
        stays = counts[which] >= copies
        if not stays.all():
            at, mixed, group = at[stays], mixed[stays], group[stays]
        breaks = np.concatenate(([True], (np.diff(at) != 1) | (np.diff(group.astype(np.int64)) != 0))) if len(at) else np.zeros(0, bool)
        if stays.all():
            heads = np.flatnonzero(breaks)
            return at[heads], at[np.append(heads[1:], len(at)) - 1] + passage
        group = np.cumsum(breaks).astype(np.uint64)
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def runs_of_texts(codes: np.ndarray, starts: np.ndarray, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and (start, period, length) of the runs of all texts, by text, start and period."""
    copies = least_copies(exponent, least)
    if copies >= 2:
        firsts, ends = dense_stretches(codes, starts, copies)
    else:
        firsts, ends = starts[:-1], starts[1:]
    long = ends - firsts >= max(least, exponent)
    found, owner = [], []
    for first, end in zip(firsts[long].tolist(), ends[long].tolist(), strict=True):
        text = int(np.searchsorted(starts, first, side="right")) - 1
        shift = first - int(starts[text])
        for start, period, length in runs_of(codes[first:end].tolist(), exponent, least):
            found.append((start + shift, period, length))
            owner.append(text)
    found, owner = np.array(found, np.int64).reshape(-1, 3), np.array(owner, np.int64)
    order = np.lexsort((found[:, 1], found[:, 0], owner))
    return owner[order], found[order]


def collapse(words: pa.LargeBinaryArray, codes: np.ndarray, starts: np.ndarray, owner: np.ndarray, runs: np.ndarray) -> pa.LargeStringArray:
    """Each text's words joined by one blank, without those that a run holds after its first period."""
    change = np.zeros(len(codes) + 1, np.int64)
    first = starts[owner] + runs[:, 0]
    np.add.at(change, first + runs[:, 1], 1)
    np.add.at(change, first + runs[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    at = np.searchsorted(kept, starts)
    last = np.zeros(len(kept), bool)
    last[at[1:][np.diff(at) > 0] - 1] = True
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(words) + 1 + words.offset)[words.offset:]
    size = np.diff(bounds)
    if not len(words):
        return pa.array([""] * (len(starts) - 1), pa.large_string())
    # every word twice: with a blank behind it, and plain for a text's last word
    plain = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
    values = np.concatenate([np.insert(plain, bounds[1:] - bounds[0], 32), plain])
    out, ends = joined(values, np.concatenate([size + 1, size]), codes[kept] + np.where(last, len(words), 0))
    offsets = np.concatenate(([0], ends))[at].astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(out)))


def periodic_runs(docs: DataFrame, exponent: int = 4, least: int = 6, id_column: str = "doc_id", text_column: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Runs of words of every whole text, one row per row of docs: doc_id, n_words, runs, collapsed.

    runs: array of (start, period, length) by start and period, of the stretches with smallest period q and
    length >= max(least, exponent * q), exponent 2 or more; words are numbered from 0. collapsed: the words that no run
    holds after its first period, joined by one blank. Words are runs of characters other than 0x20 and 0x09 to 0x0D.
    A null, empty or blank text has no words, no runs and an empty collapsed text. Repeated rows and rows without an id
    are texts of their own; other columns are left out; an empty table gives no rows.
    """
    if exponent < 2 or least < 2:
        raise ValueError("a run has two periods at least")
    ship_package(docs.sparkSession)
    kind = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=slice_bytes):
                words = words_of(part.column("text"))
                owner, runs = runs_of_texts(words.codes, words.starts, exponent, least)
                offsets = pa.array(np.searchsorted(owner, np.arange(part.num_rows + 1)), pa.int32())
                rows = pa.StructArray.from_arrays([pa.array(runs[:, k], pa.int64()) for k in range(3)], names=["start", "period", "length"])
                text = collapse(words.distinct, words.codes, words.starts, owner, runs).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(words.starts), pa.int64()), pa.ListArray.from_arrays(offsets, rows), text], schema.names)

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)
