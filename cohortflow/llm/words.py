"""Words of whole text columns as arrays: one pass over the bytes, each distinct word once.

Executors need this package on their path, as the operators that use it run Arrow batches through Python.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

#: Bytes of text that are taken apart at once; a longer text goes alone.
SLICE_BYTES = 8 << 20


class Words(NamedTuple):
    """distinct: binary array of the different words; codes: the words in order; starts: where each text's words begin."""

    distinct: pa.LargeBinaryArray
    codes: np.ndarray
    starts: np.ndarray


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most so many bytes of text, or one row."""
    if not batch.num_rows:
        return
    ends = np.cumsum(_lengths(batch.column(column)))
    first = 0
    while first < batch.num_rows:
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


@lru_cache(maxsize=1)
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def parts(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of all batches. What was freed goes back to the system after each batch, as a worker outlives its task."""
    for batch in batches:
        yield from slices(batch, column, most)
        del batch
        _trim()(0)


def _lengths(texts: pa.Array) -> np.ndarray:
    return np.diff(text_bytes(texts)[1])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and where each begins; null counts as empty."""
    texts = (texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1 + texts.offset)[texts.offset:]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def ascii_lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z in UTF-8 bytes; all else stays."""
    return np.frombuffer(data.tobytes().lower(), np.uint8)


def is_space(data: np.ndarray) -> np.ndarray:
    """Bytes 0x20 and 0x09 to 0x0D, which UTF-8 uses for nothing else."""
    return (data == 32) | (data - np.uint8(9) < 5)


def words_of(texts: pa.Array, lower: bool = False, lead: bool = False, whole: np.ndarray | tuple = (), lower_plain: bool = False) -> Words:
    """Runs without white space of every whole text.

    lower: A-Z are lower-cased first. lead: a word keeps the white space before it, and white space that ends a text
    is a word, so that a text's words joined are the text. whole: positions of texts that are one word each, with lead.
    lower_plain: without lead, A-Z are lower-cased in words of ASCII alone that don't hold '<|'; others stay as they are.
    """
    data, bounds = text_bytes(texts)
    if lower:
        data = ascii_lower(data)
    space = is_space(data)
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    if lead:
        begins = space.copy()
        begins[1:] &= ~space[:-1]
    else:
        begins = ~space
        begins[1:] &= space[:-1]
    begins |= first[:-1] if lead else first[:-1] & ~space
    for i in whole:
        begins[bounds[i] + 1:bounds[i + 1]] = False
    at = np.flatnonzero(begins)
    starts = np.searchsorted(at, bounds)
    if lead:
        ends = np.append(at[1:], len(data))
        offsets = np.append(at, len(data)).astype(np.int64)
        kept = data
    else:
        kept = data[~space]
        filled = np.concatenate(([0], np.cumsum(~space)))
        offsets = np.append(filled[at], len(kept)).astype(np.int64)
        if lower_plain and len(at):
            other = kept >= 128
            other[:-1] |= (kept[:-1] == ord("<")) & (kept[1:] == ord("|"))
            other[offsets[1:-1] - 1] = kept[offsets[1:-1] - 1] >= 128  # the next byte is another word's
            stays = np.repeat(np.logical_or.reduceat(other, offsets[:-1]), np.diff(offsets))
            kept = np.where(stays, kept, ascii_lower(kept))
    flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))])
    coded = flat.dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), starts)


def _kinds() -> bytes:
    """Per byte: 0 of a letter, 1 digit, 2 another sign, 3 none of these for certain. Bytes from 0x80 on are of U+00C0 to U+023F, or 3."""
    kinds = np.full(256, 3, np.uint8)
    kinds[33:127] = 2
    kinds[ord("0"):ord("9") + 1] = 1
    kinds[ord("A"):ord("Z") + 1] = kinds[ord("a"):ord("z") + 1] = 0
    kinds[0x80:0xC0] = kinds[0xC3:0xC9] = 0
    return kinds.tobytes()


KINDS = _kinds()


def odd_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which words hold anything but printable ASCII and letters of U+00C0 to U+023F, a capital I with a dot, or '<|'.

    data: the words' bytes in a row, without white space; offsets: where each begins, and the last's end. The letters allowed
    compose with none of each other and become one letter each in lower case, in every version of Unicode that has them.
    """
    if not len(data):
        return np.zeros(len(offsets) - 1, bool)
    odd = np.frombuffer(data.tobytes().translate(KINDS), np.uint8) == 3
    for lead, others in ((0xC3, (0x97, 0xB7)), (0xC4, (0xB0,)), (ord("<"), (ord("|"),))):
        at = np.flatnonzero(data[:-1] == lead)
        odd[at[np.isin(data[at + 1], others) & ~_begun(at + 1, offsets)]] = True
    found = np.zeros(len(offsets) - 1, bool)
    found[np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1] = True
    return found


def _begun(at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a word begins at these bytes, or the words end there."""
    return offsets[np.searchsorted(offsets, at)] == at


def _contractions(data: np.ndarray, begins: np.ndarray, offsets: np.ndarray) -> None:
    """Joins an apostrophe that begins a piece with s, t, m, d, re, ve or ll behind it; what follows them begins a piece."""
    at = np.flatnonzero(data == ord("'"))
    at = at[begins[at] & (at + 1 < len(data))]
    at = at[~_begun(at + 1, offsets)]
    one = data[at + 1]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    more = at + 2 < len(data)
    two = np.where(more, data[np.where(more, at + 2, 0)], 0)
    long = more & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
    long[long] = ~_begun(at[long] + 2, offsets)
    begins[at[short | long] + 1] = False
    after = np.concatenate((at[short] + 2, at[long] + 3))
    begins[after[after < len(data)]] = True


def pieces_of(words: list[bytes]) -> Words:
    """Words without white space, cut into contractions, runs of letters, single digits and runs of other signs.

    A-Z are lower-cased in them. Words that odd_words names stay whole and as they are. The cuts are those of the pattern
    's|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+ in lower-cased words. starts: where each word's pieces begin.
    """
    data = np.frombuffer(b"".join(words), np.uint8)
    offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))))
    odd, lower = odd_words(data, offsets), ascii_lower(data)
    kinds = np.frombuffer(data.tobytes().translate(KINDS), np.uint8)
    begins = kinds == 1
    begins[1:] |= kinds[1:] != kinds[:-1]
    begins[offsets[:-1]] = True
    _contractions(lower, begins, offsets)
    if odd.any():
        stays = np.repeat(odd, np.diff(offsets))
        lower = np.where(stays, data, lower)
        begins &= ~stays
        begins[offsets[:-1]] = True
    edges = np.append(np.flatnonzero(begins), len(data))
    flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(lower)])
    coded = flat.dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(edges, offsets))


def joined(values: list[np.ndarray] | np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values: all distinct words' arrays in a row, lengths: of each. Returns the arrays of the coded words in a row, and each word's end."""
    begins = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    size = lengths[codes]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    step = np.ones(total, np.int64)
    some = size > 0
    heads = ends[some] - size[some]
    froms = begins[codes[some]]
    if total:
        last = np.concatenate(([0], froms[:-1] + size[some][:-1] - 1))
        step[heads] = froms - last
        step[0] = froms[0]
    return values[np.cumsum(step)], ends
