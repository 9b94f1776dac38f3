"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry_points

SQL = entry_points.oracle_sql()
duckdb = pytest.importorskip("duckdb")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    return value


def ordered(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = entry_points.queries()[name](spark, sf_dir)
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.columns, df.collect()) == ordered(columns, result.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan


def test_entry_and_names(spark):
    assert entry_points.entry(spark).count() > 0
    names = entry_points.queries()
    assert set(SQL) <= set(names) and all(name[0] in "abcdefhijl" or name.startswith(("op", "pipeline")) for name in names)
