import pytest
from pyspark.sql import functions as F

from cohortflow import config, session
from cohortflow.catalog.base import profile
from cohortflow.catalog.etl import RAW_NAMES
from cohortflow.operators import rules
from cohortflow.plans import medallion
from cohortflow.sources import files, tables
from cohortflow.streaming import ingest

HEADER = ",".join(name for name, _ in config.RAW_FIELDS)


def line(i, segment="A", ident=None):
    return f"{ident or i},Male,Yes,{20 + i},No,Artist,1.0,Low,2.0,Cat_1,{segment}"


def write(folder, name, lines):
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw, "1.csv", [line(1), line(2, "B")])
    write(raw, "2.csv", [line(3, "Z"), line(4, "C", ident="not a number")])
    write(raw, "3.csv", [line(5, "D")])
    return raw


def run(spark, folder, tmp_path, max_files=1):
    query = ingest.append_available(ingest.csv_stream(spark, str(folder), config.raw_schema(), max_files),
                                    str(tmp_path / "bronze"), str(tmp_path / "offsets"))
    query.awaitTermination()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_stream_is_batched_stamped_and_repeatable(spark, folder, tmp_path):
    assert len(run(spark, folder, tmp_path)) == 3
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    assert bronze.count() == 5 and bronze.filter("ingest_timestamp IS NULL").count() == 0
    assert bronze.select("ingest_timestamp").distinct().count() == 3
    assert run(spark, folder, tmp_path) == []
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 5
    write(folder, "4.csv", [line(6)])
    assert run(spark, folder, tmp_path) == [1]
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 6


def test_unparsable_ids_end_in_quarantine(spark, folder, tmp_path):
    run(spark, folder, tmp_path, max_files=3)
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    bad = medallion.silver_quarantine(bronze).collect()
    assert sorted(tuple(r["failed_rules"]) for r in bad) == [("valid_id",), ("valid_segmentation",)]
    good = medallion.silver(bronze)
    assert good.count() == 3 and "ingest_timestamp" not in medallion.gold_complete(good).columns


def test_rules_accept_a_stream(spark, folder, tmp_path):
    stream = ingest.csv_stream(spark, str(folder), config.raw_schema(), 3)
    silver = medallion.silver(stream)
    assert silver.isStreaming and rules.quarantine(medallion.typed(stream), config.ROW_RULES).isStreaming
    ingest.append_available(silver, str(tmp_path / "silver"), str(tmp_path / "o")).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "silver")).collect()) == [1, 2, 5]


def test_csv_round_trip_inference_and_preview(spark, sf_dir, tmp_path, rows):
    df = profile(spark, sf_dir)
    raw = df.toDF(*[RAW_NAMES[c] for c in df.columns])
    files.write_csv(raw, str(tmp_path / "csv"), files=2)
    back = files.read_csv(spark, str(tmp_path / "csv"), config.raw_schema())
    assert rows(back) == rows(raw.withColumn("ID", F.col("ID").cast("int")))
    inferred = files.read_csv(spark, str(tmp_path / "csv"))
    assert dict(inferred.dtypes)["Age"] == "int" and inferred.count() == raw.count()
    preview = files.preview_csv(spark, str(tmp_path / "csv"), 7)
    assert preview.count() == 7 and {t for _, t in preview.dtypes} == {"string"}


def test_landing_a_date_again_replaces_only_that_date(spark, tmp_path):
    path = str(tmp_path / "landed")
    files.land_batch(spark.range(3), path, "2024-01-01")
    files.land_batch(spark.range(4), path, "2024-01-02")
    files.land_batch(spark.range(2), path, "2024-01-02")
    back = spark.read.option("header", True).csv(path)
    assert {str(r["batch_date"]): r["count"] for r in back.groupBy("batch_date").count().collect()} == {
        "2024-01-01": 3, "2024-01-02": 2}


def test_named_tables(spark):
    tables.create_database(spark, "shop")
    tables.create_database(spark, "shop")
    tables.first_load({"shop.train": spark.range(3).withColumn("label", F.lit("a")),
                       "shop.test": spark.range(2).withColumn("label", F.lit("a"))}, drop={"shop.test": ["label"]})
    train, test = tables.read_table(spark, "shop.train"), tables.read_table(spark, "shop.test")
    assert test.columns == ["id", "inserted_at"]
    assert train.select("inserted_at").union(test.select("inserted_at")).distinct().count() == 1
    tables.write_table(spark.range(1), "shop.results", comment="it's a table")
    tables.append_rows(spark.range(2), "shop.results")
    assert tables.read_table(spark, "shop.results").count() == 3
    details = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED shop.results").collect()}
    assert details["Comment"] == "it's a table"
    tables.write_table(spark.range(5), "shop.results")
    assert tables.read_table(spark, "shop.results").count() == 5


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert session.scratch_path(spark, "x").startswith(named)
    settled = session.settle(spark.range(4))
    assert settled.count() == 4 and all(named in path for path in settled.inputFiles())
