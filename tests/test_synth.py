from collections import Counter

import pytest

from cohortflow.operators import synth


@pytest.fixture(scope="module")
def source(spark):
    data = [(i, "ab"[i % 2], None if i % 10 == 0 else float(i % 7), None if i % 4 == 0 else f"v{i % 3}",
             "AAAB"[i % 4] if i % 9 else "C") for i in range(400)]
    return spark.createDataFrame(data, "id long, t string, x double, w string, label string").cache()


def test_shares_support_and_types(spark, source):
    made = synth.synthetic_rows(source, "label", 4000)
    assert made.dtypes == source.dtypes
    got = made.collect()
    assert len(got) == 4000 and sorted(r["id"] for r in got) == list(range(1, 4001))
    want, have = Counter(r["label"] for r in source.collect()), Counter(r["label"] for r in got)
    for label, n in want.items():
        assert abs(have[label] / 4000 - n / 400) < 0.03
    assert {r["x"] for r in got} <= {None, *map(float, range(7))}
    nulls = sum(r["x"] is None for r in got) / 4000
    assert abs(nulls - 0.1) < 0.03
    # B rows have odd numbers only, so t is always 'b' there
    assert {r["t"] for r in got if r["label"] == "B"} == {"b"}


def test_rows_are_reproducible_and_seeded(source, rows):
    first = rows(synth.synthetic_rows(source, "label", 200, seed=1))
    assert first == rows(synth.synthetic_rows(source.repartition(9), "label", 200, seed=1))
    assert first != rows(synth.synthetic_rows(source, "label", 200, seed=2))


def test_wide_columns_are_drawn_like_narrow_ones(spark, rows):
    """A column with a hot value and many rare ones, on both paths."""
    data = [(i, "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"v{i % 90}"), "pq"[i % 2]) for i in range(600)]
    df = spark.createDataFrame(data, "id long, w string, label string")
    narrow = synth.synthetic_rows(df, "label", 700)
    wide = synth.synthetic_rows(df, "label", 700, max_levels=10)
    assert rows(wide) == rows(narrow)


def test_split_and_many_classes(source, rows):
    features, target = synth.synthetic_split(source, "label", 50)
    assert features.columns == ["id", "t", "x", "w"] and target.columns == ["label"]
    assert rows(synth.synthetic_rows(source, "label", 400, max_levels=1)) == rows(synth.synthetic_rows(source, "label", 400))
