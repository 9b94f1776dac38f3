"""Shards: even bytes, groups kept together, quotas, odd rows."""

import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import sharding
from cohortflow.llm.queries import op12_shards
from tests.llm.helpers import ODD, SCHEMA, prose


def checked(rows, got, shards):
    """Whole, right sizes, slots gapless; returns the bytes by shard and each text's shards."""
    facts = Counter((i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == facts
    slots, loads, spread = defaultdict(list), np.zeros(shards), defaultdict(Counter)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        spread[r["size"], r["text_crc32"]][r["shard"]] += 1
        assert r["law"] == "bytes" and 0 <= r["shard"] < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads, spread


def test_lots_are_dealt_evenly():
    rng = random.Random(1)
    lots = [(k, i, rng.randint(1, 2 ** k)) for k in range(1, 12) for i in range(50)]
    load = np.array([5000.0, 0, 100, 0])
    where = sharding.deal(lots, load)
    assert set(where) == {(k, i) for k, i, _ in lots} and load.max() - load.min() < 10
    assert load.sum() == 5100 + sum(n for *_, n in lots)


def test_quotas_fill_no_shard_beyond_its_capacity():
    rng = np.random.default_rng(3)
    for _ in range(200):
        wanted = rng.integers(0, 100, (5, 5)) * (1 - np.eye(5, dtype=int))
        load = wanted.sum(1) + rng.integers(0, 50, 5)
        capacity = np.maximum(load, rng.integers(0, 400, 5))
        given = sharding.quotas(wanted, load, capacity)
        assert (given >= 0).all() and (given <= wanted).all()
        assert (load + given.sum(0) - given.sum(1) <= capacity + 1 + 5).all()
    swap = np.array([[0, 30], [50, 0]])
    assert sharding.quotas(swap, np.array([100, 100]), np.array([100, 100])).tolist() == [[0, 30], [30, 0]]


def test_groups_stay_together_and_bytes_are_even(spark):
    rng = random.Random(4)
    texts = [prose(i, rng.randint(1, 60)) for i in range(900)]
    rows = [(i, texts[i]) for i in range(900)] + [(900 + i, texts[rng.randrange(0, 120)]) for i in range(400)] + [(2000 + i, texts[3]) for i in range(60)]
    rng.shuffle(rows)
    loads, spread = checked(rows, sharding.shard(spark.createDataFrame(rows, SCHEMA), 8).collect(), 8)
    assert loads.max() - loads.min() <= 0.002 * loads.mean()
    cut = sum(len(s) - 1 for s in spread.values())
    assert cut <= 2, cut


def test_a_group_larger_than_a_shard_fills_few_shards(spark):
    rows = [(i, "the same text " * 20) for i in range(1000)] + [(1000 + i, prose(i, 40)) for i in range(1500)]
    loads, spread = checked(rows, sharding.shard(spark.createDataFrame(rows, SCHEMA), 8).collect(), 8)
    assert loads.max() - loads.min() <= 0.01 * loads.mean()
    large = max(spread.values(), key=lambda s: sum(s.values()))
    share = 1000 * len(("the same text " * 20).encode()) / loads.mean()
    assert sum(sorted(large.values())[-int(np.ceil(share)) - 1:]) >= 950


def test_links_may_be_another_column(spark):
    docs = spark.createDataFrame([(i, prose(i, 30), None if i % 3 else i % 30) for i in range(600)], "doc_id long, text string, site int")
    got = sharding.shard(docs, 4, groups=F.col("site")).join(docs.select("doc_id", "site"), "doc_id")
    assert all(r["n"] == 1 for r in got.filter("site IS NOT NULL").groupBy("site").agg(F.countDistinct("shard").alias("n")).collect())
    assert got.count() == 600


def test_odd_rows(spark):
    rows = [*ODD, (None, None), (None, ""), (20, None), (20, None), (20, "")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", shard int, piece string")
    for n in (1, 3, 16):
        checked(rows, sharding.shard(docs, n).collect(), n)
    assert sharding.shard(docs.limit(0), 4).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(docs, 0)


def test_the_same_rows_give_the_same_shards(spark):
    rows = [(i, prose(i % 150, 30)) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    one, two = (sorted(map(tuple, sharding.shard(d, 8).collect())) for d in (docs, docs.repartition(7)))
    assert one == two


def test_query_over_the_small_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_shards(spark, sf_dir)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    loads, spread = checked(rows, got.collect(), 16)
    assert loads.max() - loads.min() <= 0.01 * loads.mean()
    assert sum(len(s) - 1 for s in spread.values()) == 0
