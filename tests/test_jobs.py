from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cohortflow.catalog.base import profile
from cohortflow.catalog.etl import RAW_NAMES
from cohortflow.plans import jobs, medallion
from cohortflow.sources import files, tables


def test_from_csv_to_predictions(spark, sf_dir, tmp_path):
    df = profile(spark, sf_dir)
    raw = df.toDF(*[RAW_NAMES[c] for c in df.columns])
    files.write_csv(raw, str(tmp_path / "raw"), files=2)
    files.write_csv(raw.drop("Segmentation"), str(tmp_path / "fresh"), files=1)
    tables.create_database(spark, "gold")
    places = replace(jobs.Places.below(str(tmp_path / "lake")), silver="gold.silver_profiles", gold_complete="gold.complete")

    jobs.ingest(spark, str(tmp_path / "raw"), places, max_files=1)
    jobs.layers(spark, places)
    silver = tables.read_table(spark, places.silver)
    assert silver.count() + tables.read_table(spark, places.quarantine).count() == df.count()
    assert spark.catalog.getTable(places.silver).description == jobs.COMMENTS["silver"]
    complete = tables.read_table(spark, places.gold_complete)
    assert complete.count() == silver.count() and complete.columns[-1] == "id"
    assert tables.read_table(spark, places.gold_lookup).count() == 9

    with pytest.raises(Exception):
        jobs.features(spark, places)  # nothing was fitted yet
    jobs.refit(spark, places)
    jobs.features(spark, places)
    scaled, plain = jobs.training_frames(spark, places)
    assert scaled.count() == plain.count() == silver.count()

    candidates = {"scaled": [("logistic", {"maxIter": [5]})], "plain": [("tree", {"maxDepth": [2]})]}
    best = jobs.select(spark, places, "segments", candidates, folds=2)
    assert tables.read_table(spark, places.results).count() == 2
    assert jobs.retrain(spark, places, "segments") == 2
    jobs.select(spark, places, "segments", candidates, folds=2)
    log = tables.read_table(spark, places.model_log)
    assert sorted(r["version"] for r in log.collect()) == [1, 2, 3]
    assert {r["features"] for r in log.filter("version < 3").collect()} == {best.features}

    out = jobs.score(spark, str(tmp_path / "fresh"), places, "segments")
    want = medallion.silver(raw.drop("Segmentation"), {"valid_id": "id IS NOT NULL"}).count()
    assert 0 < out.count() <= want
    assert tables.read_table(spark, places.predictions).count() == out.count()
    with pytest.raises(ValueError):
        jobs.retrain(spark, places, "unknown")
    assert out.filter(F.col("prediction").isNull()).count() == 0
