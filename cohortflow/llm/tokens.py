"""Ids of whole texts with each distinct word encoded once: a bounded cache in arrays, and the tokenizers library behind it."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cohortflow.llm.words import Words, joined, odd_words, pieces_of, words_of

#: Bytes of distinct words whose ids a Python worker keeps; beyond it starts anew.
KEPT_BYTES = 32 << 20
#: Words given to the library at once.
LIBRARY_BATCH = 20_000
#: Pieces that make up one text for the library, with blanks between them.
TEXT_PIECES = 100
#: The normaliser and the splitter under which pieces_of cuts as the file does, and pieces with blanks between stay apart.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTER = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
#: White space beyond ASCII; a byte-level splitter joins it with the blanks beside it, so such texts stay whole.
WIDE_SPACE = r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _listed(words: pa.LargeBinaryArray) -> list[bytes]:
    """to_pylist for an array without nulls, in a quarter of its time."""
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    flat, ends = (data[bounds[0]:bounds[-1]].to_pybytes() if data else b""), (bounds - bounds[0]).tolist()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


class ChunkCache:
    """Ids of distinct words, compared in full. encode_chunks gives the ids of new ones in a row and their numbers."""

    def __init__(self, encode_chunks: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], kept_bytes: int = KEPT_BYTES) -> None:
        self.encode_chunks, self.kept_bytes = encode_chunks, kept_bytes
        self.empty()

    def empty(self) -> None:
        """Forget all words."""
        self.keys, self.sizes, self.ids = pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin and the last's end."""
        found = pc.index_in(words.distinct, value_set=self.keys)
        at = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = words.distinct.filter(pc.is_null(found))
        if len(new):
            if self.keys.nbytes + new.nbytes > self.kept_bytes:
                self.empty()
                new, at = words.distinct, np.full(len(words.distinct), -1)
            ids, sizes = self.encode_chunks(_listed(new))
            at[at < 0] = len(self.keys) + np.arange(len(new))
            self.keys = pa.concat_arrays([self.keys, new])
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        flat, ends = joined(self.ids, self.sizes, at[words.codes])
        return flat, np.concatenate(([0], ends))[words.starts]


class LibraryEncoder:
    """What Tokenizer.encode(text, add_special_tokens=False).ids gives for whole texts, without truncation and padding.

    byte_level: the file's splitter keeps white space and puts a blank before a word into it; words are then taken with
    the white space before them, at which the splitter always splits. Otherwise the splitter drops white space; if the file
    cuts words as pieces_of does, each distinct piece is encoded once, many in a text, and a token that ends a word ends a piece.
    """

    def __init__(self, path: str, byte_level: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share out the cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.byte_level = byte_level
        self.ending = None if byte_level else _ending_tokens(path)
        self.pieces = ChunkCache(self._encode_pieces)
        self.cache = ChunkCache(self._encode_chunks if self.ending is None else self._encode_words)

    def empty(self) -> None:
        """Forget all words and pieces."""
        self.cache.empty()
        self.pieces.empty()

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, bounds = self.pieces.encode(pieces_of(words))
        return ids, np.diff(bounds)

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        odd = odd_words(np.frombuffer(b"".join(pieces), np.uint8), offsets)
        plain = [p for p, o in zip(pieces, odd.tolist(), strict=True) if not o]
        texts = [b" ".join(plain[i:i + TEXT_PIECES]).decode() for i in range(0, len(plain), TEXT_PIECES)]
        found = [np.zeros(0, np.uint32)]
        for first in range(0, len(texts), LIBRARY_BATCH // TEXT_PIECES):
            found += [np.array(c.ids, np.uint32) for c in self.library.encode_batch_fast(texts[first:first + LIBRARY_BATCH // TEXT_PIECES], add_special_tokens=False)]
        ids = np.concatenate(found)
        plain_sizes = np.diff(np.flatnonzero(self.ending[ids]), prepend=-1)
        if len(plain_sizes) != len(plain) or plain_sizes.sum() != len(ids):
            return self._encode_chunks(pieces)  # a file without a token for each sign at a word's end
        whole_ids, whole_sizes = self._encode_chunks([p for p, o in zip(pieces, odd.tolist(), strict=True) if o])
        order = np.empty(len(pieces), np.int64)
        order[~odd], order[odd] = np.arange(len(plain)), len(plain) + np.arange(len(whole_sizes))
        sizes = np.concatenate([plain_sizes, whole_sizes])
        return joined(np.concatenate([ids, whole_ids]), sizes, order)[0], sizes[order]

    def _encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat: list[int] = []
        sizes: list[int] = []
        for first in range(0, len(chunks), LIBRARY_BATCH):
            texts = [c.decode() for c in chunks[first:first + LIBRARY_BATCH]]
            for coded in self.library.encode_batch_fast(texts, add_special_tokens=False):
                ids = coded.ids
                flat += ids
                sizes.append(len(ids))
        return np.array(flat, np.uint32), np.array(sizes, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin and the last's end. Null counts as empty."""
        if self.byte_level:
            wide = pc.match_substring_regex(texts.fill_null(""), WIDE_SPACE).to_numpy(zero_copy_only=False)
            return self.cache.encode(words_of(texts, lead=True, whole=np.flatnonzero(wide)))
        # the file lower-cases, but composes letters and marks first, and special tokens' case matters
        return self.cache.encode(words_of(texts, lower_plain=True))


def _ending_tokens(path: str) -> np.ndarray | None:
    """Which ids end a word, if the file normalises and splits as pieces_of expects, or None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, normalizer, splitter = spec["model"], spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    suffix = model.get("end_of_word_suffix")
    alike = normalizer.get("normalizers") == NORMALIZER and splitter.get("pretokenizers", [{}])[0] == SPLITTER
    if not alike or not suffix or any("<|" not in t["content"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        return None
    ending = np.zeros(1 + max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]), bool)
    ending[[i for name, i in model["vocab"].items() if name.endswith(suffix)]] = True
    return ending


@lru_cache(maxsize=4)
def library_encoder(path: str, byte_level: bool) -> LibraryEncoder:
    """One per Python worker and file."""
    return LibraryEncoder(path, byte_level)
