from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortflow.functions import columns as C
from cohortflow.operators import features, folds
from cohortflow.plans import medallion
from cohortflow.sources.models import load_stages, save_model


@pytest.fixture(scope="module")
def inputs(small_silver):
    return medallion.feature_input(small_silver)


def test_width_follows_the_numeric_types(inputs):
    narrow = features.features_of(inputs, features.fit_features(inputs), ["id"])
    wide = features.features_of(inputs, features.fit_features(inputs, numeric_types="all"), ["id"])
    assert (C.vector_size(narrow), C.vector_size(wide)) == (34, 35)
    assert narrow.columns == ["id", "features"]


def test_null_and_unseen_values_get_the_last_but_one_slot_family(spark):
    train = spark.createDataFrame([(1, 1, "a"), (2, 2, "a"), (3, 3, "b"), (4, 4, None)], "id int, n int, s string")
    model = features.fit_features(train)
    new = spark.createDataFrame([(1, 1, "a"), (2, None, None), (3, 2, "never seen")], "id int, n int, s string")
    got = {r["id"]: list(r["v"]) for r in
           features.features_of(new, model, ["id"]).select("id", vector_to_array("features").alias("v")).collect()}
    # n was never NULL when fitting and is imputed all the same
    assert got == {1: [1.0, 1.0, 0.0, 0.0], 2: [2.0, 0.0, 0.0, 1.0], 3: [2.0, 0.0, 0.0, 1.0]}


def test_text_only_number_only_and_boolean_columns(spark):
    df = spark.createDataFrame([(1, "a", True, 1), (2, "b", None, 2)], "id int, s string, b boolean, n int")
    for part, width in ((["id", "s"], 3), (["id", "n"], 1), (["id", "b", "n"], 2)):
        model = features.fit_features(df.select(*part))
        assert C.vector_size(features.features_of(df.select(*part), model, ["id"])) == width


def test_saved_stages_give_the_same_vectors(inputs, tmp_path, rows):
    model = features.fit_features(inputs, scale=True)
    save_model(model, str(tmp_path / "m"))
    save_model(model, str(tmp_path / "m"))  # overwrites
    again = load_stages(str(tmp_path / "m"))
    assert rows(features.features_of(inputs, again, ["id"])) == rows(features.features_of(inputs, model, ["id"]))


def test_flag_columns(spark):
    df = spark.createDataFrame([("x", "Low", 1), (None, "High", 2), ("y", None, 3)], "p string, s string, id int")
    out = features.flag_columns(df, ["p"], {"s": ["Low", "Average", "High"]})
    assert out.columns == ["p_x", "p_y", "p_missing", "s", "id"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        (1.0, 0.0, 0.0, 0.0, 1), (0.0, 0.0, 1.0, 2.0, 2), (0.0, 1.0, 0.0, None, 3)]
    with pytest.raises(ValueError):
        features.levels_of(df, ["p"], max_levels=1)


def test_folds_are_a_partition_and_even_within_each_label(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "b").alias("label"))
    seen = None
    for parts in (1, 6):
        got = folds.stratified_folds(df.repartition(parts), "label", "id", folds=3).collect()
        assert len({r["id"] for r in got}) == len(got) == 1000
        sizes = Counter((r["label"], r["fold"]) for r in got)
        for label in ("hot", "b", None):
            counts = [sizes[(label, f)] for f in range(3)]
            assert max(counts) - min(counts) <= 1
        assignment = {r["id"]: r["fold"] for r in got}
        assert seen is None or seen == assignment
        seen = assignment
    assert seen != {r["id"]: r["fold"] for r in folds.stratified_folds(df, "label", "id", seed=14).collect()}


def test_fold_split(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "id int, fold int")
    train, held = folds.fold_split(df, 1)
    assert (train.count(), held.count()) == (6, 3)
    assert held.select("fold").distinct().first()[0] == 1


def test_columns_with_too_many_levels_are_refused(spark):
    df = spark.range(300).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    with pytest.raises(ValueError):
        features.fit_features(df, max_levels=100)
