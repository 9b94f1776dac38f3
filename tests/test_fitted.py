import pytest
from pyspark.ml import Pipeline, PipelineModel

from cohortflow.operators.fitted import LevelFlags, ValueFill, ValueMap
from cohortflow.sources.models import load_stages, save_model

SCHEMA = "id long, kind string, size string, x double, n int, yes string"


@pytest.fixture
def train(spark):
    return spark.createDataFrame([(1, "a", "S", 1.0, 3, "Yes"), (2, "a", "L", 5.0, None, "No"), (3, None, "S", 2.0, 3, None), (4, "b", None, None, 4, "Yes")], SCHEMA)


@pytest.fixture
def later(spark):
    return spark.createDataFrame([(9, "new", "M", None, None, None), (10, None, None, 7.0, 8, "Maybe")], SCHEMA)


def stages():
    return Pipeline(stages=[
        ValueFill(constants={"yes": "No"}, modes=["kind", "size", "yes"], medians=["x", "n"], error=0.0),
        ValueMap(maps={"yes": {"Yes": 1, "No": 0}}),
        LevelFlags(columns=["kind"], ordered={"size": ["S", "M", "L"]})])


def test_later_rows_get_training_values_after_saving(train, later, tmp_path):
    fitted = stages().fit(train)
    save_model(fitted, str(tmp_path / "stages"))
    again = load_stages(str(tmp_path / "stages"))
    assert isinstance(again, PipelineModel)
    for model in (fitted, again):
        out = {r["id"]: r.asDict() for r in model.transform(later).collect()}
        assert out[9] == {"id": 9, "kind_a": 0.0, "kind_b": 0.0, "size": 1.0, "x": 2.0, "n": 3, "yes": 0}  # an unseen kind has no flag
        assert out[10] == {"id": 10, "kind_a": 1.0, "kind_b": 0.0, "size": 0.0, "x": 7.0, "n": 8, "yes": None}
    assert [f.dataType.simpleString() for f in again.transform(later).schema if f.name in ("x", "n")] == ["double", "int"]


def test_null_is_a_level_where_it_is_not_filled(train, later):
    model = LevelFlags(columns=["kind"]).fit(train)
    out = {r["id"]: r.asDict() for r in model.transform(later).collect()}
    assert out[10]["kind_missing"] == 1.0 and out[9]["kind_missing"] == 0.0
    with pytest.raises(ValueError):
        LevelFlags(columns=["kind"], maxLevels=1).fit(train)


def test_columns_without_values_and_absent_columns(spark, later):
    empty = spark.createDataFrame([(1, None, None, None, None, None)], SCHEMA)
    model = ValueFill(modes=["kind"], medians=["x"]).fit(empty)
    assert model.given("fills") == {}
    assert ValueFill(constants={"gone": 1, "n": 5}).fit(later).transform(later).filter("n = 5").count() == 1
    assert ValueFill(modes=["kind"]).fit(empty.limit(0)).transform(later).count() == 2
