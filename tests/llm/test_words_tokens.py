"""Words of texts and token ids against the tokenizers library."""

import itertools
import json
import random
from hashlib import sha256
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortflow.llm import bitplanes, bpe, packing, tokens
from cohortflow.llm.queries import vocabulary
from cohortflow.llm.words import slices, words_of
from tests.llm.helpers import ODD, SCHEMA, words

WORD, BYTE = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
ALPHABET = "abcdeABC  \n\t'<|>ééßΣσ1２٣K  　\x85​.,-!"


def odd_texts():
    rng = random.Random(5)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    made += ["".join(chr(rng.choice([rng.randint(1, 0x2ff), rng.randint(0x300, 0xd7ff), rng.randint(0xe000, 0x1ffff)])) for _ in range(rng.randint(0, 20))) for _ in range(800)]
    return [t for _, t in ODD if t is not None] + made


def test_words_are_the_runs_without_white_space():
    texts = odd_texts()
    found = words_of(pa.array(texts), lower=True)
    names = found.distinct.to_pylist()
    for i, text in enumerate(texts):
        got = [names[c].decode() for c in found.codes[found.starts[i]:found.starts[i + 1]]]
        assert got == words(text)


def test_words_with_white_space_make_up_the_text():
    texts = odd_texts()
    found = words_of(pa.array(texts), lead=True)
    names = found.distinct.to_pylist()
    for i, text in enumerate(texts):
        assert b"".join(names[c] for c in found.codes[found.starts[i]:found.starts[i + 1]]).decode() == text


def test_slices_keep_all_rows():
    batch = pa.record_batch({"text": pa.array(["a" * 10, None, "", "b" * 100, "c"])})
    parts = list(slices(batch, most=12))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict() and len(parts) == 3
    assert list(slices(batch.slice(0, 0))) == []


@pytest.mark.parametrize("encoder, path", [
    (bpe.TrieEncoder(WORD), WORD), (tokens.LibraryEncoder(WORD, False), WORD), (tokens.LibraryEncoder(BYTE, True), BYTE)])
def test_ids_are_those_of_the_library(encoder, path):
    texts, library = odd_texts(), Tokenizer.from_file(path)
    for _ in range(2):  # the second time from the cache
        ids, starts = encoder.encode(pa.array(texts))
        for i, coded in enumerate(library.encode_batch(texts, add_special_tokens=False)):
            assert coded.ids == ids[starts[i]:starts[i + 1]].tolist(), repr(texts[i])


@pytest.mark.parametrize("make", [lambda: bpe.TrieEncoder(WORD), lambda: tokens.LibraryEncoder(WORD, False)])
def test_marks_are_composed_before_letters_are_lower_cased(make):
    library = Tokenizer.from_file(WORD)
    marked = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "aT\u0308B Plain j\u030c", "NAME<", "|NAME", "NAME< |NAME"]
    for texts in (marked, [*marked, "<|endoftext|>A"], ["<|ENDOFTEXT|> A", *marked]):
        ids, starts = make().encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[starts[i]:starts[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


class Counted:
    """The library, with the texts that it was given."""

    def __init__(self, library):
        self.library, self.texts = library, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.library.encode_batch_fast(texts, **options)


def test_a_piece_of_words_is_encoded_once_and_many_in_one_text():
    encoder = tokens.LibraryEncoder(WORD, False)
    library, encoder.library = encoder.library, Counted(encoder.library)
    names = ["".join(p) for p in itertools.product("abcdefé", repeat=4)]
    texts = [f"{n}, ({n}) {n}. {n.title()}'s {n}!? 'd{n} {n}7{n}" for n in names]
    ids, starts = encoder.encode(pa.array(texts))
    for i, coded in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert coded.ids == ids[starts[i]:starts[i + 1]].tolist(), texts[i]
    given = encoder.library.texts
    assert sum(t.split().count("bade") for t in given) == 1 and len(given) < len(names) / 10
    encoder.empty()
    assert not len(encoder.cache.keys) and not len(encoder.pieces.keys)


@pytest.mark.parametrize("at_once", [1, 40, 100_000])
def test_pieces_are_those_of_the_library_for_every_sign(at_once):
    rng, library, encoder = random.Random(7), Tokenizer.from_file(WORD), tokens.LibraryEncoder(WORD, False)
    signs = [chr(c) for c in range(0x370)]
    texts = [f"A{c}b {c}{c}B 'S{c} '{c}s 1{c}2 <{c} |{c} x{c}" for c in signs]
    parts = ["'s", "'t", "'RE", "'ve", "'m", "'ll", "'d", "'r", "'l", "'", "''", "l", "e", "Sé", "É", "ß", "İ", "ſ", "Ⱥ", "×", "²", "12", "<|", "<", "|", "<|endoftext|>", "_", "-", " ", " "]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(6000)]
    if at_once == 1:
        texts = texts[::10]
    for first in range(0, len(texts), at_once):
        some = texts[first:first + at_once]
        ids, starts = encoder.encode(pa.array(some))
        for i, coded in enumerate(library.encode_batch(some, add_special_tokens=False)):
            assert coded.ids == ids[starts[i]:starts[i + 1]].tolist(), repr(some[i])


def test_a_file_that_cuts_otherwise_or_lacks_signs_gives_its_own_ids(tmp_path):
    cut, lacks = (json.loads(Path(WORD).read_text(encoding="utf-8")) for _ in range(2))
    cut["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
    del lacks["model"]["vocab"]["7</w>"]
    texts = ["it's 1984, or 19a!!", "Été 12", "7", "a7b 77 c"]
    for i, spec in enumerate((cut, lacks)):
        (path := tmp_path / f"{i}.json").write_text(json.dumps(spec), encoding="utf-8")
        library = Tokenizer.from_file(str(path))
        ids, starts = tokens.LibraryEncoder(str(path), False).encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_small_cache_gives_the_same_ids():
    texts = odd_texts()
    encoder, other = bpe.TrieEncoder(WORD), bpe.TrieEncoder(WORD)
    other.cache.kept_bytes = 100
    for part in (texts[:500], texts[500:], texts[:700]):
        assert np.array_equal(encoder.encode(pa.array(part))[0], other.encode(pa.array(part))[0])


def test_trie_shares_prefixes_and_finds_what_merges_give():
    encoder = bpe.encoder(WORD)
    coded = encoder.encode_words(["then", "thenation", "thenations", "th", "t", "a" * 50])
    library = Tokenizer.from_file(WORD)
    for word, ids in coded.items():
        assert ids == library.encode(word, add_special_tokens=False).ids


def test_round_trip_query(spark):
    library = Tokenizer.from_file(WORD)
    docs = spark.createDataFrame(ODD, SCHEMA)
    found = sorted(map(tuple, bpe.digests(docs, WORD).collect()), key=repr)
    want = []
    for doc, text in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), sha256(np.array(ids, "<u4")).hexdigest(), sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert found == sorted(want, key=repr)
    whole = {r.doc_id: r for r in bpe.encode_decode(docs.filter("doc_id = 5"), WORD).collect()}
    assert library.decode(whole[5].ids, skip_special_tokens=False) == whole[5].decoded
    assert bpe.encode_decode(docs.limit(0), WORD).count() == 0


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(1)
    for kind, most in (("<u4", 2 ** 32), ("<u4", 50_000), ("<i8", 2 ** 40), ("u1", 2)):
        for n in (0, 1, 7, 1000):
            values = rng.integers(0, most, n).astype(kind)
            assert np.array_equal(bitplanes.from_planes(bitplanes.to_planes(values, bits), n, kind, bits), values)


@pytest.mark.parametrize("bits", [False, True])
def test_files_hold_all_documents(spark, tmp_path, bits):
    docs = spark.createDataFrame(ODD, SCHEMA).repartition(3)
    manifest = bitplanes.write_ids(docs, BYTE, f"file://{tmp_path}/planes", bits=bits, block_ids=64, file_ids=500)
    assert {r.path.rsplit("/", 1)[1][:3] for r in manifest.collect()} == {"ids"}
    assert sum(r.n_docs for r in manifest.collect()) == len(ODD)
    found = sorted(map(tuple, bitplanes.read_ids(manifest).collect()), key=lambda r: r[1])
    library, at, want = Tokenizer.from_file(BYTE), 0, []
    for doc, text in sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0)):  # the one id that repeats has one text
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((doc, at, len(ids), crc32(ids)))
        at += len(ids)
    assert found == want


def test_no_documents_no_files(spark):
    assert bitplanes.written_and_read(spark.createDataFrame([], SCHEMA), BYTE).count() == 0


def test_a_broken_file_is_refused(tmp_path):
    (tmp_path / "x").write_bytes(b"IDPLANE1" + b"\0" * 40)
    with pytest.raises(ValueError):
        bitplanes.PlaneReader(pa.OSFile(str(tmp_path / "x")))


def check_packing(rows, docs, window):
    library, seen, places = Tokenizer.from_file(WORD), {}, {}
    for r in rows:
        seen.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = {}
    for doc, text in docs:
        want.setdefault(doc, []).append(np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4"))
    assert set(seen) == set(want)
    for doc, several in want.items():
        pieces = [(s, min(window, len(ids) - s), crc32(ids[s:s + window]), len(ids)) for ids in several for s in range(0, len(ids), window)]
        assert sorted(seen[doc]) == sorted(pieces)
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return places


def test_packing(spark):
    docs = [*ODD, *[(100 + i, "word " * (i % 37)) for i in range(300)]]
    rows = packing.pack(spark.createDataFrame(docs, SCHEMA), WORD, window=64).collect()
    places = check_packing(rows, docs, 64)
    assert sorted(places) == list(range(len(places)))
    full = sum(sum(n for _, n in p) for p in places.values())
    assert full / (64 * len(places)) > 0.97
    assert packing.pack(spark.createDataFrame([], SCHEMA), WORD).count() == 0


def test_a_worker_keeps_no_words_of_a_task_that_packed():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(40)), "text": [f"kept word{i} " * 50 for i in range(40)]})
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    pieces = packing._pieces(WORD, 2, 4096, names)(iter([batch]))
    assert next(pieces).num_rows == 40 and len(tokens.library_encoder(WORD, False).cache.keys) > 40
    assert not list(pieces) and not len(tokens.library_encoder(WORD, False).cache.keys)


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(2)
    for n in (0, 1, 50, 20_000):
        counts = np.bincount(np.minimum(511, np.exp(rng.normal(4, 1, n)).astype(int) + 1), minlength=513)
        counts[512] = n // 7
        counts[9] += n // 3  # one length with a third of all pieces
        runs = packing.plan(counts, 512)
        used = np.zeros(513, int)
        for r in runs:
            assert r.count > 0 and sum(r.lengths) <= 512
            np.add.at(used, list(r.lengths), r.count)
        assert np.array_equal(used, counts)


def test_least_squares_meets_a_histogram_that_patterns_can_make():
    counts = np.zeros(101)
    counts[[60, 40, 25, 50]] = (30, 30, 40, 20)
    patterns = packing.combinations(np.flatnonzero(counts), 100)
    x = packing.least_squares(patterns, counts, 400)
    use = np.zeros(101)
    for p, n in zip(patterns, x, strict=True):
        np.add.at(use, list(p), n)
    assert (x >= 0).all() and np.abs(use - counts).max() < 2
