"""Runs of words against brute force, the automaton's parts, odd rows and the digests of the query."""

import random
import re
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from cohortflow.llm import periodic
from cohortflow.llm.queries import op11_periodic_runs, with_repeated_tails
from cohortflow.llm.words import words_of
from tests.llm.helpers import ODD, SCHEMA, prose


def brute_runs(words, exponent, least):
    """Longest stretches in which words `period` apart are identical, each with its smallest period."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        begin = None
        for i in range(len(words) - period + 1):
            same = i < len(words) - period and words[i] == words[i + period]
            if same and begin is None:
                begin = i
            if not same and begin is not None:
                found.setdefault((begin, i + period), period)
                begin = None
    return sorted((b, p, e - b) for (b, e), p in found.items() if e - b >= max(least, exponent * p))


def brute_collapsed(words, runs):
    drop = {i for start, period, length in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def splits(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_words(doc_id, text):
    words = splits(text)
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def made(rng):
    n = rng.randint(0, 70)
    words = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(n)]
    if n and rng.random() < 0.5:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 3))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("exponent, least", [(2, 2), (4, 6), (3, 3), (2, 7)])
def test_runs_are_those_of_brute_force(exponent, least):
    rng = random.Random(exponent * 10 + least)
    for _ in range(800):
        words = made(rng)
        expected = brute_runs(words, exponent, least)
        assert periodic.runs_of(words, exponent, least) == expected, words


def test_texts_taken_apart_give_the_same_runs():
    rng = random.Random(3)
    texts = [made(rng) for _ in range(500)] + [[], [1], [1] * 6, [1] * 5, [1, 2] * 4, [1, 2, 3] * 4, [1, 2, 3] * 3 + [1, 2]]
    codes, starts = np.concatenate([np.array(t, np.int64) for t in texts]), np.cumsum([0, *map(len, texts)])
    for exponent, least in ((4, 6), (2, 2), (3, 3)):
        owner, runs = periodic.runs_of_texts(codes, starts, exponent, least)
        expected = [(k, *r) for k, t in enumerate(texts) for r in brute_runs(t, exponent, least)]
        assert [(k, *r) for k, r in zip(owner.tolist(), runs.tolist(), strict=True)] == [tuple(map(int, e)) for e in expected]


def test_automaton_and_last_places():
    rng = random.Random(8)
    symbols = [rng.randrange(2) for _ in range(60)]
    built = periodic.Automaton(symbols)
    assert len(built.size) <= 2 * len(symbols) + 1
    places = periodic.LastPlaces(built.link)
    for i, state in enumerate(built.prefix):
        longest = {}
        for earlier, deepest in places.access(state, i):
            longest[earlier] = max(longest.get(earlier, 0), built.size[deepest])
        for length in range(1, i + 2):  # the last place before i at which the suffix ended
            suffix = symbols[i - length + 1:i + 1]
            ended = max((e for e in range(length - 1, i) if symbols[e - length + 1:e + 1] == suffix), default=-1)
            assert longest[ended] >= length


def test_long_periods_and_one_word_take_linear_time():
    words = list(range(3_000)) * 5 + [0] * 20_000
    # the first word of a sixth copy goes on the long run and begins the short one
    assert periodic.runs_of(words, 4, 6) == [(0, 3_000, 15_001), (15_000, 1, 20_000)]


def test_collapsed_texts_of_a_slice():
    texts = ["a b a b a b a b c", "", None, " \n", "x", "é é é é é é é", "a  b\tc"]
    words = words_of(pa.array(texts))
    owner, runs = periodic.runs_of_texts(words.codes, words.starts, 4, 6)
    assert periodic.collapse(words.distinct, words.codes, words.starts, owner, runs).to_pylist() == ["a b c", "", "", "", "x", "é", "a b c"]


def test_odd_rows_and_clashing_names(spark):
    rows = [(i, t, "extra", 1) for i, t in ODD]
    docs = spark.createDataFrame(rows, SCHEMA + ", runs string, n_words int")
    got = periodic.periodic_runs(docs, slice_bytes=1000).collect()
    expected = []
    for i, t, *_ in rows:
        w = splits(t)
        found = brute_runs(w, 4, 6) if len(w) < 50 else [(0, 6, len(w))]
        expected.append((i, len(w), found, brute_collapsed(w, found)))
    key = lambda r: (str(r[0]), r[1], r[3])
    assert sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=key) == sorted(expected, key=key)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, exponent=1)


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, prose(i, rng.choice([0, 1, 3, 30, 90]), rng.choice([2, 30]))) for i in range(300)] + ODD[:6]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert [r["text"] for r in with_repeated_tails(docs).collect()] == [
        " ".join(brute_words(i, t)) if i is not None and splits(t) and crc32(str(i).encode()) % 10 == 0 else t for i, t in rows]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    expected = []
    for i, t in rows:
        words = brute_words(i, t)
        runs = brute_runs(words, 4, 6)
        s, q, n = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else (None, None, None)
        listed = "".join(f"{a},{c},{b}\n" for a, b, c in runs)
        expected.append((i, len(runs), s, n, q, 1000 * n // q if runs else None, sha256(listed.encode()).hexdigest(),
                         sha256(brute_collapsed(words, runs).encode()).hexdigest()))
    got = op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert dict(got.dtypes)["exponent_milli"] == "bigint" and dict(got.dtypes)["n_runs"] == "bigint"
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert any(e[1] for e in expected)
