"""Byte-pair encoding by prefix-sharing trie traversal.

A batch's distinct words are put into a trie and visited depth first. Every node keeps one state: the last token of the
encoding of the prefix that ends there. The encoding of a prefix is that of the shorter prefix before its last token, plus
this token, so a node's state follows from its ancestors' and words with a common prefix share the work for it. Sorted
words are the depth-first order of their trie; the states on the path to the current node are kept in a stack.

A token may end a prefix if merging it with the token before it gives these two tokens back; exactly one token can.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortflow.llm.shipping import ship_package
from cohortflow.llm.tokens import ChunkCache
from cohortflow.llm.words import slices, words_of

#: Added to the code point of a symbol that ends a word.
FINAL = 0x2000
_ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


class TrieEncoder:
    """Encodes and decodes with a tokenizer file: word-end BPE, byte alphabet, normaliser and splitter of the file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.end = spec["model"]["end_of_word_suffix"] or ""
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        vocab = spec["model"]["vocab"]
        self.names = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for name, token in [*vocab.items(), *self.special.items()]:
            self.names[token] = name
        self.encoded_names = [name.encode() for name in self.names]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self._learn(vocab, merges)
        self.cache = ChunkCache(self.encode_chunks)

    def symbols(self, name: str) -> str:
        """One character per base symbol of a token; a symbol that ends a word has its own."""
        if self.end and name.endswith(self.end):
            body = name[: -len(self.end)]
            return body[:-1] + chr(ord(body[-1]) + FINAL)
        return name

    def _learn(self, vocab: dict[str, int], merges: list[tuple[str, str]]) -> None:
        never = len(merges)
        self.rank = {vocab[a] << 32 | vocab[b]: r for r, (a, b) in reversed(list(enumerate(merges)))}
        # parts of a token: (right edge token, rank of the token it is part of), and the same for the left edge
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        text: dict[int, str] = {}
        for name, token in vocab.items():
            if len(s := self.symbols(name)) == 1:
                self.right[token] = self.left[token] = [(token, never)]
                text[token] = s
        for r, (a, b) in enumerate(merges):
            x, y, made = vocab[a], vocab[b], vocab[self._merged(a, b)]
            if made in text or x not in text or y not in text or not self._joins(x, y, r):
                continue  # another merge makes it, or its own symbols never end as it
            text[made] = text[x] + text[y]
            self.right[made] = [(made, never)] + [(t, r if t == y else above) for t, above in self.right[y]]
            self.left[made] = [(made, never)] + [(t, r if t == x else above) for t, above in self.left[x]]
        self.length = {t: len(s) for t, s in text.items()}
        self.steps: list[dict[str, int]] = [{}]
        own: list[int] = [-1]
        for token, s in text.items():
            at = 0
            for ch in s:
                if (after := self.steps[at].get(ch)) is None:
                    after = self.steps[at][ch] = len(self.steps)
                    self.steps.append({})
                    own.append(-1)
                at = after
            own[at] = token
        self.back = [0] * len(self.steps)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(self.steps)
        level = [0]
        while level:
            below = []
            for at in level:
                for ch, after in self.steps[at].items():
                    b = self.back[at]
                    while at and b and ch not in self.steps[b]:
                        b = self.back[b]
                    self.back[after] = self.steps[b].get(ch, 0) if at else 0
                    mine = ((own[after], self.length[own[after]]),) if own[after] >= 0 else ()
                    self.ending[after] = mine + self.ending[self.back[after]]
                    below.append(after)
            level = below
        self.known = [dict(s) for s in self.steps]
        self.follows: dict[int, bool] = {}

    def _merged(self, a: str, b: str) -> str:
        return a + b

    def _joins(self, x: int, y: int, rank: int) -> bool:
        """Whether x and y, each encoded whole, meet as such before another merge takes symbols of both."""
        for a, above_a in self.right[x]:
            for b, above_b in self.left[y]:
                if (a, b) != (x, y) and (m := self.rank.get(a << 32 | b)) is not None and m < rank and m < above_a and m <= above_b:
                    return False
        return True

    def can_follow(self, x: int, y: int) -> bool:
        """Whether the symbols of x then y are encoded as these two tokens: no merge across the border comes first."""
        key = x << 32 | y
        if (ok := self.follows.get(key)) is None:
            ok = True
            for a, above_a in self.right[x]:
                for b, above_b in self.left[y]:
                    if (m := self.rank.get(a << 32 | b)) is not None and m < above_a and m <= above_b:
                        ok = False
            if len(self.follows) > 2_000_000:
                self.follows.clear()
            self.follows[key] = ok
        return ok

    def _step(self, at: int, ch: str) -> int:
        start = at
        while at and ch not in self.steps[at]:
            at = self.back[at]
        self.known[start][ch] = after = self.steps[at].get(ch, 0)
        return after

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """The ids of each word, given as characters of the byte alphabet."""
        out: dict[str, list[int]] = {}
        known, ending, follows, length = self.known, self.ending, self.follows, self.length
        spelled = sorted((w[:-1] + chr(ord(w[-1]) + FINAL), w) if self.end else (w, w) for w in words if w)
        states, last, before = [0], [-1], ""
        for s, word in spelled:
            shared, most = 0, min(len(s), len(before))
            while shared < most and s[shared] == before[shared]:
                shared += 1
            del states[shared + 1:], last[shared + 1:]
            at, depth = states[-1], shared
            for ch in s[shared:]:
                after = known[at].get(ch)
                at = self._step(at, ch) if after is None else after
                depth += 1
                for token, size in ending[at]:
                    if size == depth:
                        break
                    previous = last[depth - size]
                    if (ok := follows.get(previous << 32 | token)) is None:
                        ok = self.can_follow(previous, token)
                    if ok:
                        break
                else:
                    raise ValueError(f"a symbol of {word!r} is not in the vocabulary")
                states.append(at)
                last.append(token)
            ids, left = [], depth
            while left:
                ids.append(last[left])
                left -= length[last[left]]
            ids.reverse()
            out[word] = ids
            before = s
        return out

    def pieces(self, chunk: str) -> list[str | int]:
        """Words of the byte alphabet, and ids of special tokens, in a run of text without white space around it."""
        if chunk.isascii() and chunk.isprintable() and "<|" not in chunk:
            return _ASCII_PIECE.findall(chunk.lower())
        out: list[str | int] = []
        for part in self.special_pattern.split(chunk) if self.special_pattern else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += [p for p, _ in self.split(self.normalize(part))]
        return out

    def encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has."""
        words: set[str] = set()
        parts: list[list[str | int]] = []
        for chunk in chunks:
            if chunk.isalpha() and chunk.islower():  # letters a-z only: a word of the byte alphabet as it is
                parts.append([chunk.decode()])
            else:
                parts.append(self.pieces(chunk.decode()))
            words.update(p for p in parts[-1] if isinstance(p, str))
        coded = self.encode_words(list(words))
        flat: list[int] = []
        sizes = []
        for part in parts:
            had = len(flat)
            for p in part:
                if isinstance(p, str):
                    flat += coded[p]
                else:
                    flat.append(p)
            sizes.append(len(flat) - had)
        return np.array(flat, np.uint32), np.array(sizes, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin and the last's end. Null counts as empty."""
        # case matters to special tokens, and to letters that are composed with marks before they are lower-cased
        return self.cache.encode(words_of(texts, lower_plain=True))

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8: token names with blanks between, as the file names no decoder."""
        return b" ".join(map(self.encoded_names.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    """One per Python worker and file."""
    return TrieEncoder(path)


def encode_decode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns id_column, ids (array of long) and decoded. A null or empty text has no ids and an empty decoded text; rows
    that repeat come back as often; other columns are left out. path must name the file on every executor.
    """
    from pyspark.sql import functions as F, types as T

    ship_package(docs.sparkSession)
    kind = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField(id_column, kind), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, starts = e.encode(part.column("text"))
                rows = [e.decode(ids[a:b]).decode() for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int64))), pa.array(rows, pa.string())], [id_column, "ids", "decoded"])

    return docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """encode_decode with the ids and the decoded text as their SHA-256, so that no long row leaves the Python worker.

    Returns id_column, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256.
    """
    from pyspark.sql import functions as F, types as T

    ship_package(docs.sparkSession)
    kind = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField(id_column, kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, starts = e.encode(part.column("text"))
                ids = ids.astype("<u4")
                spans = list(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(starts), pa.int64()),
                    pa.array([sha256(ids[a:b]).hexdigest() for a, b in spans], pa.string()),
                    pa.array([sha256(e.decode(ids[a:b])).hexdigest() for a, b in spans], pa.string()),
                ], schema.names)

    return docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)
