"""Exact and near deduplication against brute force."""

import hashlib
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cohortflow.llm import exactdup, neardup
from cohortflow.llm.components import components
from cohortflow.llm.queries import QUERIES
from tests.llm.helpers import ODD, SCHEMA, prose, words


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def exact(rows):
    same = defaultdict(list)
    for doc, text in rows:
        same[lowered(text)].append(doc)
    out = []
    for text, ids in same.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("table_bytes", [1 << 27, 20_000])
def test_exact_groups(spark, table_bytes):
    rng = random.Random(3)
    rows = ODD + [(20 + i, rng.choice(["Copy", "copy", "COPY of it", prose(i % 40, 30), "É", "é"])) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, exactdup.groups(docs, table_bytes).collect()), key=repr) == exact(rows)


def test_exact_groups_of_nothing(spark):
    assert exactdup.groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_table_compares_whole_texts():
    table = exactdup.TextTable()
    for text in (b"a", b"b", b"c"):  # one hash for all: probing has to go on
        entry, at = table.find(7, text)
        assert entry == -1
        table.add(7, text, at)
    assert [table.find(7, t)[0] for t in (b"a", b"b", b"c", b"d")] == [0, 1, 2, -1]
    for i in range(5000):
        table.add(i, str(i).encode(), table.find(i, str(i).encode())[1])
    assert all(table.find(i, str(i).encode())[0] == 3 + i for i in range(5000)) and table.find(7, b"c")[0] == 2


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near(rows):
    """Links of all pairs by an index of shingles; rows that share an id are one node."""
    sets, index, up = [(i, shingles(t)) for i, t in rows], defaultdict(list), {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (doc, mine) in enumerate(sets):
        if doc is None:
            continue
        shared = defaultdict(int)
        for s in mine:
            for j in index[s]:
                shared[j] += 1
            index[s].append(k)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(mine) + len(sets[j][1]) - n):
                a, b = find(doc), find(sets[j][0])
                up[max(a, b)] = min(a, b)
    return sorted(((i, len(s), find(i), True if i is None else find(i) == i) for i, s in sets), key=repr)


def edited(rng, text, share):
    return " ".join(f"edit{rng.randint(0, 10**9)}" if rng.random() < share else w for w in text.split())


def family_rows():
    """A group of near copies of one text, some too far from it; a chain; a passage that many share; short texts."""
    rng = random.Random(11)
    base = prose(1, 160)
    rows = [(1000 + i, edited(rng, base, rng.choice([0.01, 0.02, 0.03, 0.06, 0.12]))) for i in range(120)]
    chain = prose(2, 200).split()
    for i in range(12):  # each near the one before it only
        rows.append((2000 + (i * 5) % 12, " ".join(chain)))
        chain = chain[12:] + prose(50 + i, 12).split()
    passage = prose(3, 80)
    rows += [(3000 + i, f"{passage} {prose(100 + i, 60)}") for i in range(40)]
    rows += [(4000 + i, prose(200 + i // 2, 8)) for i in range(20)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [256, 7])
def test_near_duplicates(spark, block):
    rows = ODD + family_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = sorted(map(tuple, neardup.near_duplicates(docs, block=block).collect()), key=repr)
    assert found == near(rows)


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [tuple(r) for r in neardup.near_duplicates(spark.createDataFrame([(3, None)], SCHEMA)).collect()] == [(3, 0, 3, True)]


def test_near_dedup_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op4_near_dedup"].run(spark, sf_dir).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, found), key=repr) == near(rows)


def test_sets_and_signatures_of_a_large_batch_take_little_memory():
    batch = pa.RecordBatch.from_pydict({"node": list(range(1200)), "text": [" ".join(f"w{(i * k) % 997}" for k in range(1000)) for i in range(1200)]})
    assert batch.nbytes > 5 << 20
    for run in (neardup._signed(5, 64), neardup._sets(5)):
        tracemalloc.start()
        found = sum(out.num_rows for out in run(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found == 1200 and most < 60 << 20


def test_batches_of_long_texts_are_bounded_in_bytes(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(60, numPartitions=1).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 200000) AS text")
    neardup.near_duplicates(docs.limit(1)).collect()
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert len(sizes) > 1 and max(r.n for r in sizes) < 12 << 20
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))
    neardup.near_duplicates(docs.limit(1)).collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(1 << 20)
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_units_link_each_two_components_once():
    import pandas as pd

    sets = [np.arange(a, a + 100, dtype=np.uint64) for a in (0, 1, 2, 500)]
    frame = pd.DataFrame({"node": [1, 2, 3, 4], "component": [1, 1, 3, 4], "block": [0, 0, 0, 0], "n_shingles": [100] * 4,
                          "signature": [np.zeros(64, np.uint32).tobytes()] * 4, "shingles": [s.tobytes() for s in sets]})
    assert len(neardup._across(75, 34)(frame)) == 1


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (5, 5), *[(100 + i, 101 + i) for i in range(40)], *[(7, 200 + i) for i in range(30)]]
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found[3] == found[1] == 1 and found[9] == 8 and 5 not in found
    assert {found[100 + i] for i in range(41)} == {100} and {found[200 + i] for i in range(30)} == {7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
