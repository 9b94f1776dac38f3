import math
import random

import numpy as np
import pytest

from cohortflow.operators import knn

COLUMNS = ["a", "b", "c", "d"]
SCHEMA = "id long, a double, b double, c double, d double"


def brute_force(data, k):
    """The definition, row by row: {(id, column): value}."""
    out = {}
    for row in data:
        for t in range(1, 5):
            if row[t] is not None:
                continue
            near = []
            for other in data:
                if other[t] is None:
                    continue
                shared = [j for j in range(1, 5) if j != t and row[j] is not None and other[j] is not None]
                if shared:
                    total = sum((row[j] - other[j]) ** 2 for j in shared)
                    near.append((total * 4 / len(shared), other[0], other[t]))
            near = sorted(near)[:k]
            everyone = [o[t] for o in data if o[t] is not None]
            if near or everyone:
                out[(row[0], "abcd"[t - 1])] = (sum(n[2] for n in near) / len(near)) if near else sum(everyone) / len(everyone)
    return out


def make(n, seed, spread):
    rng = random.Random(seed)

    def cell(top):
        return None if rng.random() < 0.2 else float(rng.randint(0, top))

    return [(i, cell(1), cell(spread), cell(spread), cell(2)) for i in range(n)]


@pytest.mark.parametrize("n,spread,max_cells", [(120, 6, 20000), (150, 200, 20000), (150, 200, 40), (150, 200, 16), (60, 1, 20000)])
def test_equals_brute_force_with_one_cell_per_tuple_and_with_grids(spark, n, spread, max_cells):
    data = make(n, n + spread, spread)
    got = knn.knn_values(spark.createDataFrame(data, SCHEMA).repartition(5), "id", COLUMNS, k=3, max_cells=max_cells).collect()
    want = brute_force(data, 3)
    assert {(r["id"], r["column_name"]) for r in got} == set(want)
    for r in got:
        assert math.isclose(r["value"], want[(r["id"], r["column_name"])], abs_tol=1e-9)


def test_copies_of_one_row_do_not_crowd_out_the_smaller_ids(spark):
    data = [(i, 1.0, 5.0, 5.0, float(i)) for i in range(300)] + [(999, 1.0, 5.0, 5.0, None)]
    df = spark.createDataFrame(data, SCHEMA)
    assert knn.knn_values(df, "id", COLUMNS, k=5).first()["value"] == 2.0


def test_rows_without_anything_in_common_get_the_mean(spark):
    data = [(1, None, None, None, None), (2, 1.0, 2.0, None, 4.0), (3, 3.0, 2.0, 1.0, 0.0)]
    out = {r["id"]: r for r in knn.knn_impute(spark.createDataFrame(data, SCHEMA), "id", COLUMNS, k=1).collect()}
    assert (out[1]["a"], out[1]["b"], out[1]["c"], out[1]["d"]) == (2.0, 2.0, 1.0, 2.0)
    assert out[2]["c"] == 1.0 and out[3]["a"] == 3.0


def test_nothing_to_fill_and_nan_counts_as_missing(spark):
    full = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 1.0)], SCHEMA)
    assert knn.knn_impute(full, "id", COLUMNS).collect() == full.collect()
    data = [(1, float("nan"), 1.0, 1.0, 1.0), (2, 7.0, 1.0, 1.0, 1.0)]
    out = {r["id"]: r["a"] for r in knn.knn_impute(spark.createDataFrame(data, SCHEMA), "id", COLUMNS).collect()}
    assert out == {1: 7.0, 2: 7.0}


def test_sphere_bounds_hold():
    rng = np.random.default_rng(3)
    low = rng.uniform(-1e6, 1e6, (30, 3))
    high = low + rng.uniform(0, 1e3, (30, 3))
    masks = rng.integers(0, 8, 30)
    cells = knn._Cells(masks, low, high, np.ones(30), 3)
    least, greatest = cells.bounds(cells)
    for _ in range(50):
        i, j = rng.integers(0, 30, 2)
        shared = [c for c in range(3) if not (masks[i] | masks[j]) >> c & 1]
        if not shared:
            assert np.isinf(least[i, j])
            continue
        x, y = rng.uniform(low[i], high[i]), rng.uniform(low[j], high[j])
        distance = sum((x[c] - y[c]) ** 2 for c in shared) * 3 / len(shared)
        assert least[i, j] <= distance <= greatest[i, j]


def test_pairs_of_cells_are_never_broadcast_and_narrow_columns_take_no_cells(spark):
    data = [(i, float(i * 37 % 100), float(i % 2), None if i % 7 == 0 else float(i % 11)) for i in range(120)]
    df = spark.createDataFrame(data, "id long, wide double, flag double, x double")
    plan = knn.knn_values(df, "id", ["wide", "flag", "x"], max_cells=10)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan
    ranges = {"wide": (0.0, 100.0), "flag": (0.0, 1.0)}
    cells = {level: df.selectExpr(f"{knn._cell(list(ranges), ranges, level)} AS c").distinct().count() for level in (2, 4)}
    assert cells == {2: 4, 4: 16}  # of equal width: the flag is not split before the wide column has bins as narrow


@pytest.mark.parametrize("spread,max_cells", [(200, 20000), (200, 16), (4, 40)])
def test_many_small_lots_leaves_and_meetings_find_the_same_rows(spark, monkeypatch, spread, max_cells):
    for name, value in {"LOT_ROWS": (9, 9), "MEETING": 7, "LEAF": 4, "BLOCK": 3, "AT_ONCE": 8}.items():
        monkeypatch.setattr(knn, name, value)
    data = make(150, spread, spread)
    got = knn.knn_values(spark.createDataFrame(data, SCHEMA), "id", COLUMNS, k=3, max_cells=max_cells).collect()
    want = brute_force(data, 3)
    assert {(r["id"], r["column_name"]) for r in got} == set(want) and len(got) == len(want)
    assert all(math.isclose(r["value"], want[(r["id"], r["column_name"])], abs_tol=1e-9) for r in got)


def test_what_is_written_grows_with_the_rows_not_with_their_pairs(spark, monkeypatch):
    written, settle = [], knn.settle

    def counted(df, *name):
        out = settle(df, *name)
        written.append(out.count())
        return out

    monkeypatch.setattr(knn, "settle", counted)
    data = make(900, 5, 300)
    assert len(knn.knn_values(spark.createDataFrame(data, SCHEMA), "id", COLUMNS, k=5, max_cells=40).collect()) > 600
    assert sum(written) < 6 * len(data), written


def test_ids_may_be_text_missing_or_come_twice(spark):
    rows = [("b", 1.0, 3.0), ("b", 1.0, 3.0), (None, 1.0, 9.0), ("a", 1.0, 6.0), ("c", 1.0, 90.0), ("z", 1.0, None)]
    df = spark.createDataFrame(rows, "id string, a double, b double")
    assert [r["value"] for r in knn.knn_values(df, "id", ["a", "b"], k=4).collect()] == [5.25]
