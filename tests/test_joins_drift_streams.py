import math

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cohortflow import config
from cohortflow.catalog.base import profile
from cohortflow.operators import joins, metrics, rules
from cohortflow.plans import medallion
from cohortflow.streaming import ingest
from tests.test_sources_streaming import line, write


@pytest.fixture
def skewed(spark):
    rows = [(7 if i % 3 == 0 else None if i % 50 == 1 else i, i) for i in range(3_000)]
    other = [(7, "a"), (7, "b"), (None, "c"), *((i, "d") for i in range(0, 3_000, 2))]
    return spark.createDataFrame(rows, "k int, v int"), spark.createDataFrame(other, "k int, w string")


def test_hot_keys_are_those_of_a_share(skewed):
    left, _ = skewed
    assert joins.hot_keys(left, "k", 0.2) == [7]
    assert joins.hot_keys(left, "k", 0.5) == [] and joins.hot_keys(left.limit(0), "k", 0.1) == []


def test_hot_key_join_gives_the_rows_of_the_plain_one(skewed, rows):
    left, right = skewed
    plain = rows(left.join(right, "k"))
    for share in (0.01, 0.2, 0.9):
        got = joins.hot_key_join(left, right, "k", share)
        assert got.columns == ["k", "v", "w"] and rows(got) == plain


def test_only_hot_keys_are_repeated_and_their_rows_are_spread(spark, skewed):
    left, right = skewed
    hot = joins.equi_join(left.filter("k = 7"), right.filter("k = 7"), "k", 16)
    salted = left.filter("k = 7").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(16)))
    sizes = [r["count"] for r in salted.groupBy("_salt").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * sorted(sizes)[8] and hot.count() == 2_002
    plan = joins.hot_key_join(left, right, "k", 0.2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "CartesianProduct" not in plan  # the right side of the hot keys alone


def drift(spark, a, b, **options):
    one, two = (spark.createDataFrame([(x,) for x in side], "x double") for side in (a, b))
    return metrics.numeric_drift(one, two, ["x"], **options).first()


def test_numeric_drift_by_hand(spark):
    a, b = [float(i) for i in range(1, 9)], [float(i) for i in range(3, 11)]
    got = drift(spark, a, b, bins=2)  # one cut, 4; bins: NULL, NaN, up to 4, above
    share = lambda n: (n + 0.5) / (8 + 2)
    expected = sum((share(q) - share(p)) * math.log(share(q) / share(p)) for p, q in ((4, 2), (4, 6), (0, 0), (0, 0)))
    assert got["stability_index"] == pytest.approx(expected) and got["ks_distance"] == pytest.approx(0.25)


def test_numeric_drift_of_odd_columns(spark):
    nan = float("nan")
    same = drift(spark, [1.0, 2.0, None, nan] * 50, [nan, None, 2.0, 1.0] * 50)
    assert same["stability_index"] == 0 and same["ks_distance"] == 0 and not same["drifted"]
    gone = drift(spark, [1.0, 2.0] * 50, [None] * 100)
    assert gone["drifted"] and gone["ks_distance"] is None
    assert drift(spark, [1.0] * 5, []) is not None and drift(spark, [], [1.0])["ks_distance"] is None


def test_rules_are_counted_by_the_write(spark, sf_dir, tmp_path, rows):
    bronze = profile(spark, sf_dir)
    report = medallion.write_silver(bronze, str(tmp_path / "silver"))
    assert rows(report) == rows(rules.rule_report(medallion.typed(bronze), config.ROW_RULES))
    assert rows(spark.read.parquet(str(tmp_path / "silver"))) == rows(medallion.silver(bronze))
    seen_rows, _ = rules.observed(medallion.typed(bronze), config.ROW_RULES)
    plan = rules.keep_valid(seen_rows, config.ROW_RULES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw, "1.csv", [line(1), line(2, "B"), line(9, "Z")])
    write(raw, "2.csv", [line(3, "Z"), line(4, "C", ident="not a number")])
    write(raw, "3.csv", [line(5, "D")])
    return raw


def split(spark, folder, tmp_path):
    stream = ingest.csv_stream(spark, str(folder), config.raw_schema(), 1)
    ingest.split_available(stream, *(str(tmp_path / n) for n in ("silver", "quarantine", "report", "offsets"))).awaitTermination()


def test_a_stream_cut_off_between_two_tables_loses_and_doubles_nothing(spark, folder, tmp_path, monkeypatch):
    real, failed = ingest._write_part, []

    def once(df, target, batch):
        if batch == 1 and target.endswith("quarantine") and not failed:
            failed.append(batch)
            raise OSError("cut off")
        real(df, target, batch)

    monkeypatch.setattr(ingest, "_write_part", once)
    with pytest.raises(StreamingQueryException):
        split(spark, folder, tmp_path)
    assert failed == [1] and (tmp_path / "silver" / "batch=1").exists() and not (tmp_path / "quarantine" / "batch=1").exists()
    split(spark, folder, tmp_path)
    split(spark, folder, tmp_path)  # nothing new: adds nothing
    silver, bad, report = (spark.read.parquet(str(tmp_path / n)) for n in ("silver", "quarantine", "report"))
    assert sorted(r["id"] for r in silver.collect()) == [1, 2, 5]
    assert bad.count() == 3 and sorted(r["id"] for r in bad.collect() if r["id"]) == [3, 9]
    bronze = spark.read.schema(config.raw_schema()).option("header", True).csv(str(folder))
    whole = {r["rule"]: (r["passed"], r["failed"]) for r in rules.rule_report(medallion.typed(bronze), config.ROW_RULES).collect()}
    summed = report.groupBy("rule").agg(F.sum("passed").alias("p"), F.sum("failed").alias("f")).collect()
    assert {r["rule"]: (r["p"], r["f"]) for r in summed} == whole
    write(folder, "4.csv", [line(6)])
    split(spark, folder, tmp_path)
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 4
