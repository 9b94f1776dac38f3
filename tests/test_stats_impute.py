import math

from pyspark.ml.feature import Imputer
from pyspark.sql import functions as F

from cohortflow.operators import impute, stats


def test_ties_take_the_smallest_value_and_values_before_null(spark):
    df = spark.createDataFrame([("b", None), ("a", "x"), ("b", None), ("a", "x"), (None, "y")], "p string, q string")
    for parts in (1, 4):
        got = {r["column_name"]: (r["value"], r["n"]) for r in stats.modes(df.repartition(parts), ["p", "q"]).collect()}
        assert got == {"p": ("a", 2), "q": ("x", 2)}


def test_null_as_mode_leaves_the_column(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, None), ("a", 1)], "p string, q int")
    assert rows(impute.impute_mode(df, ["p", "q"])) == sorted([(None, 1), (None, 1), ("a", 1)], key=repr)


def test_median_keeps_the_type_and_fills_everything(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (None, 3.0), (9, 4.0)], "i int, f float")
    out = impute.impute_median(df, ["i", "f"], error=0.0)
    assert out.dtypes == [("i", "int"), ("f", "float")]
    assert sorted(r["i"] for r in out.collect()) == [1, 2, 2, 9]
    assert sorted(r["f"] for r in out.collect()) == [1.0, 3.0, 3.0, 4.0]


def test_empty_and_all_null_columns_are_left(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    assert impute.impute_median(df, ["a", "b"], error=0.0).first()["a"] is None
    assert impute.impute_median(df, ["a", "b"]).first()["a"] is None
    assert stats.medians(df.filter("b > 5"), ["b"], 0.0) == {"b": None}


def test_exact_median_agrees_with_the_imputer(spark, small_silver):
    model = Imputer(inputCols=["age"], outputCols=["age"], strategy="median", relativeError=0.0).fit(small_silver)
    assert stats.medians(small_silver, ["age"], 0.0)["age"] == model.surrogateDF.first()["age"]


def test_describe_agrees_with_spark(spark, small_silver):
    ours = {r["column_name"]: r for r in stats.describe(small_silver, ["age", "profession"]).collect()}
    theirs = {r["summary"]: r for r in small_silver.select("age", "profession").describe().collect()}
    assert ours["age"]["n"] == int(theirs["count"]["age"])
    assert math.isclose(ours["age"]["mean"], float(theirs["mean"]["age"]))
    assert math.isclose(ours["age"]["stddev"], float(theirs["stddev"]["age"]))
    assert ours["profession"]["min_text"] == theirs["min"]["profession"]


def test_histograms_ignore_null_and_keep_the_upper_end(spark, rows):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("b", None), ("b", 5.0)], "c string, x double")
    assert rows(stats.histogram(df, ["x"], "c", 2)) == [("x", "a", 0, 1), ("x", "a", 1, 1), ("x", "b", 1, 1)]
    flat = spark.createDataFrame([("a", 3.0), ("a", 3.0)], "c string, x double")
    assert rows(stats.histogram(flat, ["x"], "c", 4)) == [("x", "a", 0, 2)]


def test_kinds(spark):
    df = spark.createDataFrame([(1, 5, 0.5, "a", "k1"), (2, 5, 0.7, "b", "k2"), (3, 6, 0.9, "a", "k3")],
                               "id long, n int, x double, c string, key string")
    got = {r["column_name"]: r["kind"] for r in stats.column_kinds(df).collect()}
    assert got == {"id": "id", "n": "numeric", "x": "numeric", "c": "categorical", "key": "id"}


def test_correlation_is_symmetric_and_skips_null_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, None), (3.0, 6.0, -1.0)], "a double, b double, c double")
    got = {(r["column_a"], r["column_b"]): r["corr"] for r in stats.correlation(df, ["a", "b", "c"]).collect()}
    assert math.isclose(got[("a", "b")], 1.0) and math.isclose(got[("c", "a")], -1.0)
    assert all(got[(x, y)] == got[(y, x)] for x, y in got)


def test_approximate_distinct_counts(spark):
    df = spark.range(5000).select((F.col("id") % 100).alias("k"))
    found = stats.approx_distinct_counts(df, ["k"]).first()["n_distinct"]
    assert abs(found - 100) <= 15


def test_brackets_that_miss_fall_back_to_all_values(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    whole = stats._brackets

    def off_target(*args):
        found, row = whole(*args)
        return {c: [[0.0, 1.0], [5.0, 6.0]] for c in found}, row

    monkeypatch.setattr(stats, "_brackets", off_target)
    assert stats.medians(df, ["x"], 0.0) == {"x": 499.0}


def test_quantiles_of_shuffled_numbers(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("x"), F.lit(4.0).alias("y")).repartition(6)
    found = {(r["column_name"], r["prob"]): r["value"] for r in stats.quantiles(df, ["x", "y"], [0.0, 0.3, 0.31, 1.0]).collect()}
    values = sorted(i * 7919 % 3001 for i in range(3000))
    assert found[("x", 0.3)] == values[899] and found[("x", 1.0)] == values[-1] and found[("y", 0.31)] == 4.0


def test_nan_has_no_rank(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (float("nan"),), (float("nan"),), (None,)], "x double")
    assert stats.medians(df, ["x"], 0.0) == stats.medians(df, ["x"], 0.01) == {"x": 2.0}


def test_number_ties_go_to_the_smaller_number(spark):
    df = spark.createDataFrame([(9, "9"), (9, "9"), (10, "10"), (10, "10")], "n int, t string")
    assert {r["column_name"]: r["value"] for r in stats.modes(df, ["n", "t"]).collect()} == {"n": "9", "t": "10"}


def test_sketched_summary_is_close_to_the_exact_one(spark, small_silver):
    exact = {r["column_name"]: r for r in stats.summary(small_silver, ["age"]).collect()}["age"]
    sketched = {r["column_name"]: r for r in stats.summary(small_silver, ["age"], accuracy=10000).collect()}["age"]
    assert exact == sketched
