import random

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import joins, ranking, stats


def test_numbers_follow_the_order_across_partitions(spark):
    df = spark.range(500).repartition(9).withColumn("k", F.xxhash64("id"))
    got = {r["id"]: r["row_number"] for r in ranking.number_rows(df, ["k", "id"]).collect()}
    want = [r["id"] for r in df.orderBy("k", "id").collect()]
    assert got == {v: i + 1 for i, v in enumerate(want)}


def test_numbers_per_group_with_a_hot_and_a_null_group(spark):
    values = [(None if i % 11 == 0 else ("hot" if i % 3 else f"g{i % 5}"), i) for i in range(400)]
    df = spark.createDataFrame(values, "g string, id long").repartition(7)
    seen = {}
    for r in ranking.number_rows(df, ["id"], group_by=["g"]).collect():
        seen.setdefault(r["g"], []).append((r["id"], r["row_number"]))
    for pairs in seen.values():
        assert [n for _, n in sorted(pairs)] == list(range(1, len(pairs) + 1))
    assert sum(map(len, seen.values())) == 400


def test_running_total(spark):
    rng = random.Random(5)
    data = [(rng.choice("ab"), i, rng.randint(1, 9)) for i in range(200)]
    got = {(r["g"], r["v"]): r["upto"] for r in
           ranking.running_total(spark.createDataFrame(data, "g string, v int, n int").repartition(5), ["g"], ["v"], "n").collect()}
    for g in "ab":
        total = 0
        for _, v, n in sorted(d for d in data if d[0] == g):
            total += n
            assert got[(g, v)] == total


def test_exact_quantiles_do_not_depend_on_partitions(spark):
    rng = random.Random(1)
    data = [(rng.choice([1.5, 2.0, None]) if i % 3 else rng.uniform(0, 9), i) for i in range(301)]
    df = spark.createDataFrame(data, "a double, b int")
    want = {}
    for c, column in (("a", sorted(v for v, _ in data if v is not None)), ("b", list(range(301)))):
        for p in (0.0, 0.25, 0.5, 1.0):
            want[(c, p)] = float(column[max(int(-(-p * len(column) // 1)), 1) - 1])
    for parts in (1, 8):
        got = stats.quantiles(df.repartition(parts), ["a", "b"], [0.0, 0.25, 0.5, 1.0]).collect()
        assert {(r["column_name"], r["prob"]): r["value"] for r in got} == want


def test_positional_join_and_its_order(spark, rows):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string").repartition(3)
    right = spark.createDataFrame([(10,), (30,)], "w int").repartition(2)
    assert rows(joins.positional_join(left, right, ["k"], [F.desc("w")])) == [(1, "a", 30), (2, "b", 10)]
    with pytest.raises(ValueError):
        joins.positional_join(left, right, [], ["w"])
    with pytest.raises(ValueError):
        ranking.number_rows(left, [])


def test_salted_join_equals_plain_join(spark, rows):
    left = spark.range(300).select((F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "x"), (0, "y"), (1, "z")], "k long, v string")
    assert rows(joins.equi_join(left, right, "k", salts=5)) == rows(joins.equi_join(left, right, "k"))
