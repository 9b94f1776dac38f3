"""Two tokenizers aligned: ids of whole texts, galloping against membership, groups and counts against brute force."""

import base64
import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cohortflow.llm import alignment
from cohortflow.llm.queries import op13_alignment, vocabulary
from tests.llm.helpers import ODD, SCHEMA, prose

BYTE, PIECE = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ALPHABET = "abcdeABC   \n\t'<|>ééßΣσ1２٣K　\x85​.,-!▁👍"


def odd_texts():
    rng = random.Random(7)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    made += ["".join(chr(rng.choice([rng.randint(1, 0x2ff), rng.randint(0x300, 0xd7ff), rng.randint(0xe000, 0x1ffff)])) for _ in range(rng.randint(0, 20))) for _ in range(300)]
    return [t for _, t in ODD] + made + [" ", "  ", "a ", "a  ", " a", "  a", "<s>", "</s> <unk>", "<0x41>", "x<0x0A>y", "\x00", "▁", "a▁b", "é" * 9000]


@pytest.fixture(scope="module")
def plain():
    a, b = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    return a, b


def brute(text, a, b):
    """ids of both sides and the groups as (first, end) pairs, straight from the libraries and the vocabulary entries."""
    if not text:
        return [], [], []
    alphabet = alignment.byte_alphabet()
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_parts = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in a_ids]
    b_parts = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b"" if b.is_control(i) or b.is_unknown(i)
               else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    whole = (" " + text).encode()
    if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
        return [], [], []
    a_ends, b_ends = np.cumsum([len(p) for p in a_parts]).tolist(), np.cumsum([len(p) for p in b_parts]).tolist()
    groups, i, j, last_i, last_j = [], 0, 0, 0, 0
    while i < len(a_ends):
        if a_ends[i] == b_ends[j]:
            groups.append((last_i, i + 1, last_j, j + 1))
            i, j = i + 1, j + 1
            last_i, last_j = i, j
        elif a_ends[i] < b_ends[j]:
            i += 1
        else:
            j += 1
    return a_ids, b_ids, groups


def brute_rows(rows, a, b):
    aligned = [(i, *brute(t, a, b)) for i, t in rows]
    links = [Counter((x[p], y[q]) for s, e, u, v in g for p in range(s, e) for q in range(u, v)) for _, x, y, g in aligned]
    held = Counter(pair for c in links for pair in c)
    top = {}
    for (p, _), n in held.items():
        top[p] = max(top.get(p, 0), n)
    out = []
    for (i, x, y, g), c in zip(aligned, links, strict=True):
        text = ";".join(",".join(map(str, x[s:e])) + "|" + ",".join(map(str, y[u:v])) for s, e, u, v in g)
        out.append((i, len(x), len(y), len(g), sum(c.values()), sum(n for pair, n in c.items() if held[pair] == top[pair[0]]),
                    sum(n * held[pair] for pair, n in c.items()), sha256(text.encode()).hexdigest() if x else ""))
    return out


def test_ids_are_those_of_whole_texts(plain):
    texts = odd_texts()
    a_side, b_side = alignment.ByteSide(BYTE), alignment.PieceSide(PIECE)
    assert b_side.splits
    for part in (texts, texts[:50]):
        blank = alignment.spaced(pa.array(part))
        a, b = a_side.encode(blank), b_side.encode(blank)
        for i, text in enumerate(part):
            assert a.ids[a.starts[i]:a.starts[i + 1]].tolist() == (plain[0].encode(" " + text, add_special_tokens=False).ids if text else []), repr(text)
            assert b.ids[b.starts[i]:b.starts[i + 1]].tolist() == (plain[1].encode(text) if text else []), repr(text)


def test_byte_alphabet_is_the_rank_files():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, f)}
    table = alignment.ByteSide(BYTE).bytes
    ends = np.cumsum(table.sizes)
    for token, expected in list(ranks.items())[::97]:
        assert table.values[ends[token] - table.sizes[token]:ends[token]].tobytes() == expected
    assert tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={v: k for k, v in ranks.items()}, special_tokens={}).n_vocab == len(ranks)


def test_galloping_finds_the_first_place_not_below():
    rng = np.random.default_rng(4)
    for _ in range(300):
        within = np.unique(rng.integers(0, 200, rng.integers(1, 80)))
        sought = np.unique(rng.integers(-5, 210, rng.integers(0, 40)))
        near = rng.integers(0, len(within), len(sought))
        assert np.array_equal(alignment.gallop(sought, within, near), np.searchsorted(within, sought))


def test_texts_whose_bytes_differ_have_no_tokens(plain):
    texts = ["plain text", "a▁b", "", None, "two  blanks "]
    blank = alignment.spaced(pa.array(texts))
    data, bounds = alignment.text_bytes(blank)
    side = alignment.PieceSide(PIECE)
    assert alignment.same_bytes(side.encode(blank), side.bytes, data, bounds).tolist() == [True, False, False, False, True]


def test_large_groups_are_counted_by_their_ids(monkeypatch):
    rng = np.random.default_rng(2)
    a = alignment.Tokens(rng.integers(0, 5, 40), np.array([0, 20, 40]), np.full(40, 1))
    b = alignment.Tokens(rng.integers(0, 7, 20), np.array([0, 10, 20]), np.full(20, 2))
    a.sizes[:] = 1
    groups = alignment.Groups(np.array([0, 0, 1]), np.array([0, 6, 20]), np.array([6, 14, 20]), np.array([0, 3, 10]), np.array([3, 7, 10]))
    listed = alignment.links_of(a, b, groups, 7)
    monkeypatch.setattr(alignment, "LISTED", 20)
    for x, y in zip(listed, alignment.links_of(a, b, groups, 7), strict=True):
        assert np.array_equal(x, y)
    assert listed[2].sum() == 6 * 3 + 14 * 7 + 200


@pytest.mark.parametrize("known", [0, 40, 1 << 19])
def test_counts_do_not_depend_on_what_is_sent(spark, plain, known):
    rows = [(i, prose(i % 7, 60 + i, 50)) for i in range(30)] + ODD
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", pairs string")
    got = alignment.link_strength(docs, BYTE, PIECE, known=known)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_rows(rows, *plain), key=repr)


def test_spans_and_empty_tables(spark, plain):
    docs = spark.createDataFrame(ODD, SCHEMA)
    for r in alignment.align(docs, BYTE, PIECE, spans=True).collect():
        text = [t for i, t in ODD if i == r["doc_id"]][0]
        groups = brute(text, *plain)[2] if len(text or "") < 5_000 else None
        if groups is not None:
            assert [tuple(g) for g in r["groups"]] == [(s, e - s, u, v - u) for s, e, u, v in groups]
    assert alignment.link_strength(docs.limit(0), BYTE, PIECE).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], SCHEMA)
    assert sorted(map(tuple, alignment.link_strength(blank, BYTE, PIECE).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_over_the_smallest_table(spark, sf_dir, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op13_alignment(spark, sf_dir).collect())) == sorted(brute_rows(rows, *plain))
