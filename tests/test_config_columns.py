import json

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import config
from cohortflow.functions import columns as C


def test_schema_file_equals_defaults():
    pytest.importorskip("yaml")
    assert config.load_schema(config.CONF / "schema.yml", "raw_profile") == config.raw_schema()
    assert all(f.nullable for f in config.raw_schema().fields)


def test_gold_file_equals_defaults_and_keeps_text_keys():
    pytest.importorskip("yaml")
    gold = config.load_config(config.CONF / "gold.yml")
    assert config.value_maps(gold) == config.VALUE_MAPS
    assert gold["custom_mapping_target"] == config.TARGET_MAP
    assert gold["categorical_columns"]["custom"] == config.CATEGORICAL
    assert sorted(gold["numerical_columns"]) == sorted(config.NUMERICAL)


def test_json_config(tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"t": [{"name": "a", "type": "LongType"}]}))
    assert config.load_schema(path, "t").simpleString() == "struct<a:bigint>"


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Work Experience` int, ID int")
    assert C.normalize_names(df).columns == ["work_experience", "id"]


def test_casts_give_null_instead_of_failing(spark, rows):
    df = spark.createDataFrame([(3e10, "7"), (15.9, "x"), (-0.5, None), (float("nan"), "1")], "a double, b string")
    assert rows(C.cast_columns(df, {"a": "int", "b": "int"})) == sorted(
        [(None, 7), (15, None), (0, None), (None, 1)], key=repr)


def test_cast_to_double_both_frames(spark):
    df = spark.createDataFrame([(1, True)], "a int, b boolean")
    for frame in C.cast_to_double(["a", "b"], df, df):
        assert [t for _, t in frame.dtypes] == ["double", "double"]


def test_value_maps(spark, rows):
    df = spark.createDataFrame([("Yes",), ("No",), ("maybe",), (None,)], "a string")
    assert rows(C.map_values(df, {"a": {"Yes": 1, "No": 0}})) == sorted([(1,), (0,), (None,), (None,)], key=repr)
    assert rows(df.select(C.mapped("a", {"Yes": 1}, 4))) == [(1,), (4,), (4,), (4,)]


def test_label_shift(spark, rows):
    df = spark.createDataFrame([(0,), (1,), (4,), (5,), (None,)], "label int")
    assert rows(C.shift_labels(df)) == sorted([(None,), (0,), (3,), (None,), (None,)], key=repr)


def test_types_and_roles(spark):
    df = spark.createDataFrame([(1, 1.0, "a", True, 2.0), (None, 1.0, None, None, 1.0)],
                               "i int, d double, s string, b boolean, f float")
    assert C.column_type(df, "f") == T.FloatType()
    assert C.column_roles(df) == {"num_cols": ["i", "d", "b"], "string_cols": ["s"],
                                  "num_missing_cols": ["i", "b"], "string_missing_cols": ["s"]}
    assert C.numeric_columns(df, "all") == ["i", "d", "b", "f"]


def test_vectors(spark):
    df = spark.createDataFrame([(1, Vectors.sparse(3, [1], [2.0])), (2, Vectors.dense(1.0, 0.0, 3.0))], ["id", "features"])
    dense = {r["id"]: r["features"] for r in C.densify(df).collect()}
    assert dense[1] == Vectors.dense(0.0, 2.0, 0.0) and type(dense[1]).__name__ == "DenseVector"
    wide = C.vector_to_columns(C.densify(df))
    assert wide.columns == ["id", "f0", "f1", "f2"]
    assert wide.filter("id = 2").first()["f2"] == 3.0
    assert C.vector_to_rows(df).count() == 6


def test_json_and_rounding(spark):
    df = spark.createDataFrame([("x", 1, 0.1234567)], "a string, b int, c double")
    assert df.select(C.json_text("a", "b")).first()[0] == '{"a":"x","b":1}'
    assert C.round_doubles(df).first()["c"] == 0.12346


def test_row_ids_are_unique(spark):
    df = C.with_row_id(spark.range(1000).repartition(7))
    assert df.select("row_id").distinct().count() == 1000


def test_lookup_union_keeps_order_and_duplicates(spark, rows):
    df = C.lookup_union(spark, {"a": {"x": 1}, "b": {"x": 1, "y": 0}})
    assert df.dtypes == [("string_value", "string"), ("numeric_value", "double"), ("column", "string")]
    assert rows(df) == [("x", 1.0, "a"), ("x", 1.0, "b"), ("y", 0.0, "b")]


def test_fill_and_drop(spark, rows):
    df = spark.createDataFrame([(None, "a"), ("z", None)], "p string, q string")
    assert rows(C.fill_constants(df, {"p": "Other"})) == sorted([("Other", "a"), ("z", None)], key=repr)
    assert C.drop_columns(df, "q", "not there").columns == ["p"]
    assert C.rename_cast(df.select(F.lit(3).alias("s")), "s", "label", "double").dtypes == [("label", "double")]


def test_casts_try_only_what_may_be_a_number(spark):
    from cohortflow.functions.columns import cast_columns

    texts = ["1", " 2.5 ", "-3e2", "NaN", "Infinity", "-inf", "+Inf", "word", "", None, "N", "x1", "٣", "0x1", "1d", "nan "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in ("double", "int", "decimal(10,2)"):
        guarded = [str(r[0]) for r in cast_columns(df, {"t": kind}).collect()]
        assert guarded == [str(r[0]) for r in df.selectExpr(f"try_cast(t AS {kind})").collect()]
