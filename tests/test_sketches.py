import random

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import sketches, stats


@pytest.fixture(scope="module")
def source(spark):
    rng = random.Random(6)
    data = [(i, rng.gauss(0, 10) if i % 11 else (float("nan") if i % 2 else None), rng.choice("aabbbc") if i % 7 else None, i % 5000) for i in range(20_000)]
    return spark.createDataFrame(data, "part long, x double, t string, k int").repartition(6).cache()


def report(profile):
    return {(r["column_name"], r["metric"]): (r["number"], r["text"]) for r in sketches.profile_report(profile, top=2).collect()}


@pytest.fixture(scope="module")
def both(source):
    parts = [sketches.batch_profile(source.filter(F.col("part") % 4 == i), ["x", "t", "k"]) for i in range(4)]
    stored = parts[0]
    for part in parts[1:]:
        stored = stored.unionByName(part)
    return report(sketches.batch_profile(source, ["x", "t", "k"])), report(sketches.merged_profile(stored))


def test_merged_profiles_equal_one_of_all_rows(both):
    one, merged = both
    assert set(one) == set(merged)
    for key, (number, text) in one.items():
        if key[1] in ("rows", "nulls", "min", "max", "mean", "stddev") or key[0] == "t":
            assert merged[key][0] == pytest.approx(number) and merged[key][1] == text


def test_sketches_keep_their_bounds(source, both):
    rows = source.collect()
    xs = sorted(r["x"] for r in rows if r["x"] is not None and r["x"] == r["x"])
    for found in both:
        assert abs(found["k", "distinct"][0] - 5000) <= 0.04 * 5000 and found["t", "distinct"][0] == 3
        assert abs(found["x", "distinct"][0] - len(set(xs)) - 1) <= 0.04 * len(xs)  # NaN is a value
        assert found["t", "top"] == (sum(r["t"] == "b" for r in rows), "b") and found["t", "top2"][1] == "a"
        for p in (25, 50, 75):
            rank = sum(x <= found["x", f"q{p}"][0] for x in xs) / len(xs)
            assert abs(rank - p / 100) <= 0.03


def test_exact_parts_are_those_of_the_plain_profile(source, both):
    plain = {(r["column_name"], r["metric"]): r["number"] for r in stats.table_profile(source, ["t", "k"]).collect()}
    for key, number in plain.items():
        if key[1] in ("rows", "nulls", "mean", "stddev", "min", "max"):
            assert both[0][key][0] == pytest.approx(number)


def test_profiles_of_profiles_and_no_cell_is_shuffled(spark, source, tmp_path):
    for i in range(3):
        sketches.batch_profile(source.filter(F.col("part") % 3 == i), ["x", "t"]).write.mode("append").parquet(str(tmp_path / "profiles"))
    stored = spark.read.parquet(str(tmp_path / "profiles"))
    again = sketches.merged_profile(sketches.merged_profile(stored).unionByName(sketches.batch_profile(source.limit(0), ["x", "t"])))
    assert report(again)["x", "rows"][0] == 20_000 and report(again)["t", "top"][1] == "b"
    plan = sketches.batch_profile(source, ["x", "t", "k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan and "hashpartitioning" not in plan and plan.count("Exchange SinglePartition") == 1


def test_empty_tables_and_columns(spark):
    df = spark.createDataFrame([(None, None)], "x double, t string")
    for frame in (df, df.limit(0)):
        found = report(sketches.merged_profile(sketches.batch_profile(frame)))
        assert found["x", "distinct"][0] == 0 and found["x", "q50"][0] is None and found["x", "mean"][0] is None and ("t", "top") not in found
