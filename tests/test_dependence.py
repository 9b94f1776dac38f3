import math
import random
from collections import Counter
from itertools import combinations, product

import pytest

from cohortflow.operators import dependence, synth

COLUMNS = ["label", "t", "x", "w"]


@pytest.fixture(scope="module")
def source(spark):
    rng = random.Random(2)
    data = []
    for i in range(600):
        t = rng.choice(["a", "b", None, "hot", "hot"])
        x = {"a": 1.0, "b": 2.5, None: None, "hot": 10.0}[t] if rng.random() < 0.9 else 3.0  # x follows t
        data.append((i, t, x, f"w{rng.randrange(5)}", rng.choice("PPQ")))
    return spark.createDataFrame(data, "id long, t string, x double, w string, label string").cache()


def brute_information(rows, a, b):
    n, both = len(rows), Counter((r[a], r[b]) for r in rows)
    one, two = Counter(r[a] for r in rows), Counter(r[b] for r in rows)
    found = sum(k / n * math.log(k * n / (one[x] * two[y])) for (x, y), k in both.items())
    return found - (len(one) - 1) * (len(two) - 1) / (2 * n)


def test_information_of_every_pair(source):
    rows = source.collect()
    got = {(r["column_a"], r["column_b"]): r["information"] for r in dependence.pair_information(source, COLUMNS).collect()}
    assert set(got) == set(combinations(COLUMNS, 2))
    for (a, b), value in got.items():
        assert value == pytest.approx(brute_information(rows, a, b), abs=1e-9)
    assert max(got, key=got.get) == ("t", "x") and dependence.pair_information(source.limit(0), COLUMNS).count() == 0


def weight_of(parents, weight):
    return sum(max(0.0, weight[frozenset(e)]) for e in parents.items())


def test_tree_is_a_maximum_spanning_tree():
    rng = random.Random(5)
    names = ["r", "a", "b", "c", "d"]
    for _ in range(60):
        weight = {frozenset(e): rng.uniform(-0.3, 1) for e in combinations(names, 2)}
        parents = dependence.dependence_tree([(*sorted(e), w) for e, w in weight.items()], "r", names[1:])
        best = 0.0
        for choice in product(names, repeat=4):  # every way to give each column a parent
            tree = dict(zip(names[1:], choice, strict=True))
            seen = all(_reaches(c, tree) for c in tree)
            if seen:
                best = max(best, weight_of(tree, weight))
        assert weight_of(parents, weight) == pytest.approx(best) and all(_reaches(c, parents) for c in parents)
    assert dependence.dependence_tree([("r", "a", -0.1), ("a", "b", 0.4), ("r", "b", 0.0)], "r", ["a", "b"]) == {"b": "r", "a": "b"}


def _reaches(column, tree):
    steps = 0
    while column != "r" and steps < 6:
        column, steps = tree[column], steps + 1
    return column == "r"


def test_a_star_gives_the_rows_of_independent_columns(source, rows):
    star = {"t": "label", "x": "label", "w": "label"}
    made = dependence.dependent_rows(source, "label", 500, seed=3, parents=star)
    assert made.dtypes == source.dtypes
    assert rows(made) == rows(synth.synthetic_rows(source, "label", 500, seed=3))


def test_pairs_keep_their_shares(source):
    got = dependence.dependent_rows(source, "label", 4000).collect()
    apart = synth.synthetic_rows(source, "label", 4000).collect()
    want = Counter((r["t"], r["x"]) for r in source.collect())
    have, without = (Counter((r["t"], r["x"]) for r in rows) for rows in (got, apart))
    assert set(have) <= set(want) and sorted(r["id"] for r in got) == list(range(1, 4001))
    assert all(abs(have[p] / 4000 - n / 600) < 0.03 for p, n in want.items())
    assert max(abs(without[p] / 4000 - n / 600) for p, n in want.items()) > 0.1


def test_draws_do_not_depend_on_partitions_or_plan(source, rows, monkeypatch):
    first = rows(dependence.dependent_rows(source, "label", 300, seed=1))
    monkeypatch.setattr(dependence, "BROADCAST_PARENTS", 0)
    assert rows(dependence.dependent_rows(source.repartition(7), "label", 300, seed=1)) == first
    monkeypatch.setattr(dependence, "STRETCHES", 1)
    assert rows(dependence.dependent_rows(source, "label", 300, seed=1)) == first
    assert rows(dependence.dependent_rows(source, "label", 300, seed=2)) != first


def test_thousands_of_classes(spark):
    df = spark.createDataFrame([(i, i % 5000, f"v{i % 5000 % 7}") for i in range(10_000)], "id long, label int, v string")
    got = dependence.dependent_rows(df, "label", 8000).collect()
    assert all(r["v"] == f"v{r['label'] % 7}" for r in got) and len({r["label"] for r in got}) > 3500


def test_odd_trees_and_tables(source):
    for parents in ({"t": "x", "x": "t", "w": "label"}, {"t": "label"}, {"t": "label", "x": "label", "w": "nobody"}):
        with pytest.raises(ValueError):
            dependence.dependent_rows(source, "label", 5, parents=parents)
    assert dependence.dependent_rows(source.limit(0), "label", 5).count() == 0
    assert dependence.dependent_rows(source, "label", 0).count() == 0
