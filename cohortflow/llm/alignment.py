"""Alignment of two tokenizers over the same bytes by a galloping intersection of their tokens' ends.

Both tokenizations of a text make up the same bytes, so each is a rising list of byte ends. The shorter list drives: each
of its ends is sought in the longer one, by steps that double until they pass it and a binary search in the last of them.
The ends found in both cut the tokens into groups; the differences of the common ends' ranks say how many tokens of
either side a group holds, and all tokens of a group are linked with each other across the sides.

Links are counted over all documents. The pairs that most documents hold, at most KNOWN of them, go to every task; the
others are joined with the table of counts, so the result is whole whatever the number of pairs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from cohortflow.llm.shipping import ship_package
from cohortflow.llm.tokens import ChunkCache, LibraryEncoder
from cohortflow.llm.words import Words, joined, slices, text_bytes
from cohortflow.session import settle

#: Bytes of text aligned at once; a longer text goes alone.
SLICE_BYTES = 1 << 20
#: Bytes of distinct words whose ids each side keeps in a Python worker.
KEPT_BYTES = 8 << 20
#: Pairs of a group that are listed one by one; a larger group is counted by its distinct ids.
LISTED = 4096
#: Pairs whose counts are sent to every task, at most: 16 bytes each.
KNOWN = 1 << 19
#: Bits of an id pair; above them stands the document's place in its slice.
PAIR_BITS = 40
#: What pieces write for a blank.
BLANK = "▁"


class Tokens(NamedTuple):
    """ids of all texts in a row, starts: each text's first token and the end, sizes: bytes of each token."""

    ids: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray


class Groups(NamedTuple):
    """One entry per group: its text, first token and number of tokens on either side."""

    text: np.ndarray
    a_first: np.ndarray
    a_count: np.ndarray
    b_first: np.ndarray
    b_count: np.ndarray


def byte_alphabet() -> dict[str, int]:
    """Characters of a byte-level vocabulary and their bytes: printable Latin-1 stands for itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenBytes:
    """The bytes of every id in a row and how many each has."""

    def __init__(self, entries: list[bytes]) -> None:
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.values = np.frombuffer(b"".join(entries), np.uint8)

    def __len__(self) -> int:
        return len(self.sizes)


class ByteSide:
    """Byte-level BPE of a tokenizers file; the strings of special tokens are plain text."""

    def __init__(self, path: str) -> None:
        self.encoder = LibraryEncoder(path, True)
        self.encoder.library.encode_special_tokens = True
        self.encoder.cache.kept_bytes = KEPT_BYTES
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = {token: name for name, token in spec["model"]["vocab"].items()} | {t["id"]: "" for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        self.bytes = TokenBytes([bytes(alphabet[c] for c in names.get(i, "")) for i in range(max(names) + 1)])

    def encode(self, spaced: pa.LargeStringArray) -> Tokens:
        ids, starts = self.encoder.encode(spaced)
        ids = ids.astype(np.int64)
        return Tokens(ids, starts, self.bytes.sizes[ids])


class PieceSide:
    """A sentencepiece model that puts a blank before a text. Texts come with this blank written out.

    Where the model keeps all blanks and no piece has a blank behind another character, a text is taken apart before
    each run of blanks and equal parts are encoded once; otherwise texts are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        entries = []
        for i, piece in enumerate(pieces):
            if self.model.is_byte(i):
                entries.append(bytes([int(piece[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                entries.append(b"")
            else:
                entries.append(piece.replace(BLANK, " ").encode())
        self.bytes = TokenBytes(entries)
        probe = [pieces[i] for i in self.model.encode("  a  b ")]
        self.splits = "".join(probe) == "   a  b ".replace(" ", BLANK) and not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.cache = ChunkCache(self._encode_chunks, KEPT_BYTES)

    def _encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # the model adds the first blank itself, but nothing to an empty text: a last blank alone is one piece
        coded = [[self.model.piece_to_id(BLANK)] if c == b" " else None for c in chunks]
        found = iter(self.model.encode([c[1:].decode() for c, known in zip(chunks, coded, strict=True) if known is None], num_threads=1))
        coded = [next(found) if known is None else known for known in coded]
        return np.array([i for ids in coded for i in ids], np.uint32), np.array([len(ids) for ids in coded], np.int64)

    def encode(self, spaced: pa.LargeStringArray) -> Tokens:
        data, bounds = text_bytes(spaced)
        begins = np.zeros(len(data) + 1, bool)
        if self.splits:
            begins[1:-1] = (data[1:] == 32) & (data[:-1] != 32)
            begins[3:-1] &= (data[:-3] != 0xE2) | (data[1:-2] != 0x96) | (data[2:-1] != 0x81)  # U+2581 is a blank to the model
        begins[bounds[:-1]] = True
        at = np.flatnonzero(begins[:-1])
        offsets = np.append(at, len(data)).astype(np.int64)
        flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        coded = flat.dictionary_encode()
        ids, starts = self.cache.encode(Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(at, bounds)))
        ids = ids.astype(np.int64)
        return Tokens(ids, starts, self.bytes.sizes[ids])


@lru_cache(maxsize=4)
def sides(a_path: str, b_path: str) -> tuple[ByteSide, PieceSide]:
    """One of each per Python worker and pair of files."""
    return ByteSide(a_path), PieceSide(b_path)


def spaced(texts: pa.Array) -> pa.LargeStringArray:
    """A blank before every text that isn't empty; null counts as empty."""
    data, bounds = text_bytes(texts)
    some = np.diff(bounds) > 0
    data = np.insert(data, bounds[:-1][some], 32)
    bounds = bounds + np.concatenate(([0], np.cumsum(some)))
    return pa.LargeStringArray.from_buffers(len(some), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def same_bytes(tokens: Tokens, table: TokenBytes, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Texts that aren't empty and whose tokens' bytes joined are theirs."""
    size = np.diff(bounds)
    upto = np.concatenate(([0], np.cumsum(tokens.sizes)))
    good = (size > 0) & (np.diff(upto[tokens.starts]) == size)
    made, _ = joined(table.values, table.sizes, tokens.ids[np.repeat(good, np.diff(tokens.starts))])
    differs = made != data[np.repeat(good, size)]
    heads = np.concatenate(([0], np.cumsum(size[good])))[:-1]
    if len(heads):
        good[good] = ~np.logical_or.reduceat(differs, heads)
    return good


def only(tokens: Tokens, texts: np.ndarray) -> Tokens:
    """The tokens of the chosen texts; other texts have none."""
    count = np.diff(tokens.starts)
    keep = np.repeat(texts, count)
    return Tokens(tokens.ids[keep], np.concatenate(([0], np.cumsum(count * texts))), tokens.sizes[keep])


def gallop(sought: np.ndarray, within: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For each value the first place in a rising list whose value isn't below it; the search begins at the place near.

    Steps of 1, 2, 4 .. lead away from there, up or down, until they pass the value; the last step is halved.
    """
    n = len(within)
    low, high = near.astype(np.int64) - 1, near.astype(np.int64)
    at = np.flatnonzero(within[near] < sought)
    low[at], step = near[at], 1
    while len(at):
        high[at] = np.minimum(low[at] + step, n)
        at = at[(high[at] < n)]
        at = at[within[high[at]] < sought[at]]
        low[at] = high[at]
        step *= 2
    at, step = np.flatnonzero((high == near) & (low >= 0)), 1
    at = at[within[low[at]] >= sought[at]]
    while len(at):
        high[at] = low[at]
        low[at] = np.maximum(high[at] - step, -1)
        at = at[low[at] >= 0]
        at = at[within[low[at]] >= sought[at]]
        step *= 2
    at = np.flatnonzero(high - low > 1)
    while len(at):
        middle = (low[at] + high[at]) >> 1
        below = within[middle] < sought[at]
        low[at] = np.where(below, middle, low[at])
        high[at] = np.where(below, high[at], middle)
        at = at[high[at] - low[at] > 1]
    return high


def common_ends(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of a and of b that end at the same byte of the same text, in order; both sides make up the same bytes."""
    a_ends, b_ends = np.cumsum(a.sizes), np.cumsum(b.sizes)
    a_count, b_count = np.diff(a.starts), np.diff(b.starts)
    out_a, out_b = [], []
    for short, long, short_ends, long_ends, drives, swapped in (
            (a, b, a_ends, b_ends, a_count <= b_count, False), (b, a, b_ends, a_ends, a_count > b_count, True)):
        count = np.diff(short.starts) * drives
        at = np.flatnonzero(np.repeat(drives, np.diff(short.starts)))
        if not len(at):
            continue
        text = np.repeat(np.arange(len(count)), count)
        # the same share of the way through the longer list
        rank = at - short.starts[text]
        near = long.starts[text] + rank * np.diff(long.starts)[text] // count[text]
        found = gallop(short_ends[at], long_ends, near)
        hit = np.flatnonzero(found < len(long_ends))
        hit = hit[long_ends[found[hit]] == short_ends[at[hit]]]
        out_a.append(found[hit] if swapped else at[hit])
        out_b.append(at[hit] if swapped else found[hit])
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a_last, b_last = np.concatenate(out_a), np.concatenate(out_b)
    order = np.argsort(a_last, kind="stable")
    return a_last[order], b_last[order]


def groups_of(a: Tokens, b: Tokens) -> Groups:
    """The groups between common ends: each runs from behind the last common end up to the next."""
    a_last, b_last = common_ends(a, b)
    a_first, b_first = np.concatenate(([0], a_last[:-1] + 1)), np.concatenate(([0], b_last[:-1] + 1))
    if not len(a_last):
        a_first = b_first = a_last
    text = np.searchsorted(a.starts, a_last, side="right") - 1
    return Groups(text, a_first, a_last - a_first + 1, b_first, b_last - b_first + 1)


def links_of(a: Tokens, b: Tokens, groups: Groups, b_vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, id pair (a * b_vocabulary + b) and number of links, for each pair of ids that a text holds linked."""
    pairs = groups.a_count * groups.b_count
    small = pairs <= LISTED
    g = np.repeat(np.flatnonzero(small), pairs[small])
    k = np.arange(len(g)) - np.repeat(np.cumsum(pairs[small]) - pairs[small], pairs[small])
    left = groups.a_first[g] + k // groups.b_count[g]
    right = groups.b_first[g] + k % groups.b_count[g]
    keys, times = np.unique(groups.text[g] << PAIR_BITS | (a.ids[left] * b_vocabulary + b.ids[right]), return_counts=True)
    if not small.all():
        more, often = [keys], [times]
        for h in np.flatnonzero(~small).tolist():
            a_ids, a_times = np.unique(a.ids[groups.a_first[h]:groups.a_first[h] + groups.a_count[h]], return_counts=True)
            b_ids, b_times = np.unique(b.ids[groups.b_first[h]:groups.b_first[h] + groups.b_count[h]], return_counts=True)
            more.append(groups.text[h] << PAIR_BITS | (a_ids[:, None] * b_vocabulary + b_ids).ravel())
            often.append((a_times[:, None] * b_times).ravel())
        keys, which = np.unique(np.concatenate(more), return_inverse=True)
        times = np.zeros(len(keys), np.int64)
        np.add.at(times, which, np.concatenate(often))
    return keys >> PAIR_BITS, keys & ((1 << PAIR_BITS) - 1), times


class GroupWriter:
    """Groups as text: `a1,a2|b1;a3|b2,b3`, decimal ids in order."""

    def __init__(self, a_vocabulary: int, b_vocabulary: int) -> None:
        self.shifts = np.cumsum([0, a_vocabulary, a_vocabulary, b_vocabulary, b_vocabulary])
        entries = [f"{i}{mark}".encode() for count, marks in ((a_vocabulary, ",|"), (b_vocabulary, (",", ";", ""))) for mark in marks for i in range(count)]
        self.table = TokenBytes(entries)

    def write(self, a: Tokens, b: Tokens, groups: Groups) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts' groups in a row and where each text's begin and the last's end."""
        a_kind, b_kind = np.full(len(a.ids), self.shifts[0]), np.full(len(b.ids), self.shifts[2])
        a_kind[groups.a_first + groups.a_count - 1] = self.shifts[1]
        b_kind[groups.b_first + groups.b_count - 1] = self.shifts[3]
        b_kind[b.starts[1:][np.diff(b.starts) > 0] - 1] = self.shifts[4]
        codes = np.zeros(len(a.ids) + len(b.ids), np.int64)
        codes[np.arange(len(a.ids)) + np.repeat(groups.b_first, groups.a_count)] = a.ids + a_kind
        codes[np.arange(len(b.ids)) + np.repeat(groups.a_first + groups.a_count, groups.b_count)] = b.ids + b_kind
        out, ends = joined(self.table.values, self.table.sizes, codes)
        return out, np.concatenate(([0], ends))[a.starts + b.starts]


@lru_cache(maxsize=4)
def writer(a_vocabulary: int, b_vocabulary: int) -> GroupWriter:
    return GroupWriter(a_vocabulary, b_vocabulary)


SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("a_first", "a_count", "b_first", "b_count")])


def align(docs: DataFrame, a_path: str, b_path: str, spans: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokens of a blank and each text by both tokenizers, aligned; one row per row of docs.

    doc_id, n_a, n_b, n_groups, n_links, groups_sha256 (of `a1,a2|b1;a3|b2,b3`), pairs: the id pairs that the document
    holds linked, as a * (b's vocabulary) + b, and times: how many links each has. spans: also the column groups, with
    each group's first token and number of tokens on either side. Null and empty texts, and texts that either side's
    bytes don't give back, have no tokens: zeros, an empty string and empty arrays. Repeated rows and rows without an id
    are documents of their own; other columns are left out; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    fields = [T.StructField("doc_id", docs.schema[id_column].dataType), *(T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")),
              T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))]
    schema = T.StructType(fields + ([T.StructField("groups", T.ArrayType(SPAN))] if spans else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = sides(a_path, b_path)
        write = writer(len(a_side.bytes), len(b_side.bytes))
        for batch in batches:
            for part in slices(batch, most=SLICE_BYTES):
                texts = spaced(part.column("text"))
                data, bounds = text_bytes(texts)
                a, b = a_side.encode(texts), b_side.encode(texts)
                good = same_bytes(a, a_side.bytes, data, bounds) & same_bytes(b, b_side.bytes, data, bounds)
                a, b = only(a, good), only(b, good)
                groups = groups_of(a, b)
                owner, pairs, times = links_of(a, b, groups, len(b_side.bytes))
                listed, at = write.write(a, b, groups)
                view = memoryview(listed)
                digests = [sha256(view[s:e]).hexdigest() if s < e else "" for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                n = part.num_rows
                cuts = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
                links = np.bincount(groups.text, weights=groups.a_count * groups.b_count, minlength=n).astype(np.int64)
                columns = [part.column(0), pa.array(np.diff(a.starts), pa.int64()), pa.array(np.diff(b.starts), pa.int64()),
                           pa.array(np.bincount(groups.text, minlength=n), pa.int64()), pa.array(links), pa.array(digests, pa.string()),
                           pa.ListArray.from_arrays(cuts, pa.array(pairs, pa.int64())), pa.ListArray.from_arrays(cuts, pa.array(times, pa.int64()))]
                if spans:
                    rows = [groups.a_first - a.starts[groups.text], groups.a_count, groups.b_first - b.starts[groups.text], groups.b_count]
                    inside = pa.StructArray.from_arrays([pa.array(r, pa.int64()) for r in rows], names=SPAN.names)
                    columns.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(groups.text, np.arange(n + 1)), pa.int32()), inside))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n: how many documents hold each id pair linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, n = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

    return aligned.select("pairs").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def most_held(counts: DataFrame, most: int) -> DataFrame:
    """The pairs that at least 2 ** k documents hold, for the smallest k that leaves no more than `most` of them."""
    steps = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("pairs")).orderBy(F.desc("k")).collect()
    least, total = None, 0
    for step in steps:  # one row per power of two
        total += step["pairs"]
        if total > most:
            break
        least = step["k"]
    return counts.filter(F.floor(F.log2("n")) >= least) if least is not None else counts.limit(0)


def link_strength(docs: DataFrame, a_path: str, b_path: str, known: int = KNOWN, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """align's counts and digest, and how common the links are over all documents; one row per row of docs.

    n_best: links whose pair is held by as many documents as any pair of their a id; count_sum: the sum over the links of
    the number of documents that hold their pair. Both 0 without tokens; for odd rows see align.
    known: so many pairs' counts go to every task; any number gives the same rows.
    """
    spark = docs.sparkSession
    b_vocabulary = len(sides(a_path, b_path)[1].bytes)
    aligned = settle(align(docs, a_path, b_path, id_column=id_column, text_column=text_column).withColumn("_row", F.monotonically_increasing_id()), "aligned")
    counts = settle(pair_counts(aligned), "pair_counts")
    a_id = F.expr(f"pair div {b_vocabulary}")
    # one row per a id, so no more than its vocabulary
    tops = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("top")).toArrow()
    held = most_held(counts, known).toArrow()
    top = np.zeros(int(pc.max(tops["a"]).as_py() or 0) + 1, np.int64)
    top[tops["a"].to_numpy()] = tops["top"].to_numpy()
    order = np.argsort(held["pair"].to_numpy())
    sent = spark.sparkContext.broadcast((held["pair"].to_numpy()[order], held["n"].to_numpy()[order], top))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    fields = [*(aligned.schema[n] for n in (*names, "_row")), *(T.StructField(n, T.LongType()) for n in ("n_best", "count_sum")),
              *(T.StructField(n, T.ArrayType(T.LongType())) for n in ("pairs", "times"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, top = sent.value
        for batch in batches:
            rows = batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False)
            pairs, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            row = np.repeat(np.arange(len(rows)), rows)
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            r, t, p, c = row[hit], times[hit], pairs[hit], n[at[hit]] if len(keys) else times[hit]
            best = np.zeros(len(rows), np.int64)
            total = best.copy()
            np.add.at(best, r, t * (c == top[p // b_vocabulary]))
            np.add.at(total, r, t * c)
            cuts = pa.array(np.searchsorted(row[~hit], np.arange(len(rows) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*names, "_row")), pa.array(best), pa.array(total),
                                              *(pa.ListArray.from_arrays(cuts, pa.array(x[~hit], pa.int64())) for x in (pairs, times))], [f.name for f in fields])

    part = settle(aligned.select(*names, "_row", "pairs", "times").mapInArrow(run, T.StructType(fields)), "strength")
    if held.num_rows == counts.count():
        return part.select(*names[:5], "n_best", "count_sum", "groups_sha256")
    rest = part.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("_link")).select("_row", F.col("_link.pairs").alias("pair"), F.col("_link.times").alias("times"))
    top_of = counts.groupBy(a_id.alias("_a")).agg(F.max("n").alias("_top"))
    rated = counts.withColumn("_a", a_id).join(F.broadcast(top_of), "_a")
    sums = rest.join(rated, "pair").groupBy(F.col("_row").alias("_at")).agg(
        F.sum(F.when(F.col("n") == F.col("_top"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("n") * F.col("times")).alias("_sum"))
    return part.join(sums, F.col("_row") == F.col("_at"), "left").select(
        *names[:5], (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
