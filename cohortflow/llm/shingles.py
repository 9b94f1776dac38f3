"""Sets of word shingles of whole texts, as sorted 64-bit hashes, and their MinHash signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from cohortflow.llm.words import Words, words_of

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(words: Words) -> np.ndarray:
    """64-bit hash of each distinct word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.distinct.to_pylist()), np.uint64, len(words.distinct))


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts in a row, ascending in each, and where each text's begin and the last's end.

    A-Z are lower-cased. A text with fewer words than size has the sequence of its words as its one shingle; a text
    without words has none.
    """
    words = words_of(texts, lower=True)
    h = word_hashes(words)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    n = np.diff(words.starts)
    made = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), made)
    first = words.starts[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(made) - made, made)
    length = np.minimum(n, size)[text]
    with np.errstate(over="ignore"):
        code = length.astype(np.uint64)
        for k in range(size):
            more = k < length
            code[more] = mixed(code[more] * _MULTIPLY + h[first[more] + k])
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    code, text = code[new], text[new]
    return code, np.searchsorted(text, np.arange(len(n) + 1))


def signatures(codes: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """Per text and coordinate the least 32-bit image of its shingles; 0 for a text without any."""
    out = np.zeros((len(starts) - 1, coordinates), np.uint32)
    some = np.flatnonzero(np.diff(starts))
    if len(some):
        with np.errstate(over="ignore"):
            for k in range(coordinates):
                a, b = mixed(np.array([2 * k + 1, 2 * k + 2], np.uint64))
                image = ((codes * (a | np.uint64(1)) + b) >> np.uint64(32)).astype(np.uint32)
                out[some, k] = np.minimum.reduceat(image, starts[:-1][some])
    return out
