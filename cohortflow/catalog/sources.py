"""Queries over readers, writers and streams. Files are made from the given tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import config
from cohortflow.catalog.base import ALL_RULES_SQL, PROFILE_COLUMNS, RULE_SQL, Query, profile, silver, with_ctes
from cohortflow.catalog.etl import RAW_NAMES, gold_complete_sql, report_sql
from cohortflow.functions import columns as C
from cohortflow.plans import jobs, medallion
from cohortflow.session import scratch_path
from cohortflow.sources import files, tables
from cohortflow.streaming import ingest

FILES = 4  # of the queries whose feature is the number of files in a micro-batch


def csv_folder(spark: SparkSession, sf_dir: str, number: int | None = None) -> str:
    """The profile as CSV files under its raw column names: as many as the table has partitions, or the given number."""
    df = profile(spark, sf_dir)
    path = scratch_path(spark, "raw-csv")
    files.write_csv(df.toDF(*[RAW_NAMES[c] for c in df.columns]), path, files=number)
    return path


def streamed(spark: SparkSession, sf_dir: str, max_files: int = 1, runs: int = 1, transform=None, number: int | None = None) -> DataFrame:
    """CSV folder -> stream -> parquet, read back after the given number of runs."""
    source, target, checkpoint = csv_folder(spark, sf_dir, number), scratch_path(spark, "bronze"), scratch_path(spark, "offsets")
    for _ in range(runs):
        stream = ingest.csv_stream(spark, source, config.raw_schema(), max_files)
        ingest.append_available(transform(stream) if transform else stream, target, checkpoint).awaitTermination()
    return spark.read.parquet(target)


def split_streamed(spark: SparkSession, sf_dir: str, which: str, max_files: int = 2) -> DataFrame:
    """CSV folder -> one stream -> silver, quarantine and report, one of them read back."""
    places = {name: scratch_path(spark, name) for name in ("silver", "quarantine", "report")}
    stream = ingest.csv_stream(spark, csv_folder(spark, sf_dir), config.raw_schema(), max_files)
    ingest.split_available(stream, *places.values(), scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.parquet(places[which]).drop("batch", "ingest_timestamp")


def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches' rule counts summed up."""
    return split_streamed(spark, sf_dir, "report").groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def stamps(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count("ingest_timestamp").alias("n_stamped"),
                  F.count_distinct("ingest_timestamp").alias("n_batches"))


def inferred(spark, sf_dir):
    df = C.normalize_names(files.read_csv(spark, csv_folder(spark, sf_dir)))
    return df.select(*PROFILE_COLUMNS)


def all_text(spark, sf_dir):
    """Every column read as text; the preview itself adds only a row limit."""
    return C.normalize_names(files.read_text_csv(spark, csv_folder(spark, sf_dir)))


def first_load(spark, sf_dir):
    """Two tables loaded with one insert time, the second without its label."""
    train, test = scratch_path(spark, "train"), scratch_path(spark, "test")
    df = profile(spark, sf_dir)
    tables.first_load({train: df, test: df}, drop={test: ["segmentation"]})
    both = tables.read_table(spark, train).unionByName(tables.read_table(spark, test), allowMissingColumns=True)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count("segmentation").alias("n_labels"),
                    F.count_distinct("inserted_at").alias("n_times"))


def table_name(stem: str) -> str:
    """A new table of the session's catalog."""
    return f"cohortflow_{stem}_{uuid.uuid4().hex}"


def first_load_by_name(spark, sf_dir):
    """Two named tables loaded at once, all their rows, and whether the insert time is one and the same."""
    train, test = table_name("train"), table_name("test")
    df = profile(spark, sf_dir)
    tables.first_load({train: df, test: df}, drop={test: ["segmentation"]})
    both = tables.read_table(spark, train).withColumn("part", F.lit("train")).unionByName(
        tables.read_table(spark, test).withColumn("part", F.lit("test")), allowMissingColumns=True)
    at = both.agg(F.min("inserted_at").alias("at")).first()["at"]
    return both.withColumn("one_time", F.col("inserted_at") == F.lit(at)).drop("inserted_at")


def by_name(spark, sf_dir):
    """Silver saved as a table of the catalog, read by its name."""
    name = table_name("silver")
    tables.write_table(silver(spark, sf_dir), name, comment="profiles that pass every rule")
    return tables.read_table(spark, name)


def appended(spark, sf_dir):
    target = scratch_path(spark, "appended")
    counts = silver(spark, sf_dir).groupBy("segmentation").agg(F.count(F.lit(1)).alias("n"))
    tables.append_rows(counts, target)
    tables.append_rows(counts, target)
    return tables.read_table(spark, target)


def built_tables(spark, sf_dir):
    """CSV folder -> stream -> all layers as written tables -> the complete gold table."""
    places = jobs.Places.below(scratch_path(spark, "lake"))
    jobs.ingest(spark, csv_folder(spark, sf_dir), places, max_files=FILES)
    jobs.layers(spark, places, median_error=0.0)
    return tables.read_table(spark, places.gold_complete)


_raw_types = ("SELECT CAST(id AS INT) AS \"ID\", gender AS \"Gender\", ever_married AS \"Ever_Married\", age AS \"Age\", "
              "graduated AS \"Graduated\", profession AS \"Profession\", work_experience AS \"Work_Experience\", "
              "spending_score AS \"Spending_Score\", family_size AS \"Family_Size\", var_1 AS \"Var_1\", "
              "segmentation AS \"Segmentation\" FROM profile")
_bronze_sql = with_ctes("profile", _raw_types)


def _stamps_sql(batches: int) -> str:
    return f"SELECT count(*) AS n_rows, count(*) AS n_stamped, CAST({batches} AS BIGINT) AS n_batches FROM customer"


def _without_stamp(df: DataFrame) -> DataFrame:
    return df.drop("ingest_timestamp")


QUERIES: dict[str, Query] = {
    "a11_tables_from_csv": Query(built_tables, f"SELECT * REPLACE (CAST(id AS INT) AS id) FROM ({gold_complete_sql()})"),
    "a3_streamed_csv": Query(lambda s, d: _without_stamp(streamed(s, d)), _bronze_sql),
    "a3_streamed_csv_rerun": Query(lambda s, d: _without_stamp(streamed(s, d, max_files=2, runs=2)), _bronze_sql),
    "a4_ingest_time": Query(lambda s, d: stamps(streamed(s, d, number=FILES)), _stamps_sql(FILES)),
    "j1_streamed_silver": Query(
        lambda s, d: _without_stamp(streamed(s, d, max_files=2, transform=medallion.silver)),
        with_ctes("silver", "SELECT * REPLACE (CAST(id AS INT) AS id) FROM silver")),
    "j1_split_stream_silver": Query(
        lambda s, d: split_streamed(s, d, "silver"), with_ctes("silver", "SELECT * REPLACE (CAST(id AS INT) AS id) FROM silver")),
    "j1_split_stream_quarantine": Query(
        lambda s, d: split_streamed(s, d, "quarantine", 1).select("id", F.array_join("failed_rules", ",").alias("failed_rules")),
        with_ctes("typed", "SELECT CAST(id AS INT) AS id, concat_ws(',', " + ", ".join(f"CASE WHEN NOT {r} THEN '{n}' END" for n, r in RULE_SQL.items())
                  + f") AS failed_rules FROM typed WHERE NOT ({ALL_RULES_SQL})")),
    "j1_split_stream_report": Query(
        stream_report, with_ctes("typed", f"SELECT rule, CAST(passed AS BIGINT) AS passed, CAST(failed AS BIGINT) AS failed FROM ({report_sql('typed')})")),
    "j2_bounded_batches": Query(lambda s, d: stamps(streamed(s, d, max_files=2, number=FILES)), _stamps_sql(FILES // 2)),
    "j3_batch_time": Query(lambda s, d: stamps(streamed(s, d, max_files=FILES, number=FILES)), _stamps_sql(1)),
    "a5_inferred_csv": Query(
        inferred,
        with_ctes("profile", "SELECT * REPLACE (CAST(id AS INT) AS id, CAST(work_experience AS DOUBLE) AS work_experience, "
                             "CAST(family_size AS DOUBLE) AS family_size) FROM profile")),
    "a6_text_preview": Query(
        all_text,
        with_ctes("profile", "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in PROFILE_COLUMNS) + " FROM profile")),
    "a8_shared_insert_time": Query(
        first_load,
        with_ctes("profile", "SELECT 2 * count(*) AS n_rows, count(segmentation) AS n_labels, CAST(1 AS BIGINT) AS n_times "
                             "FROM profile")),
    "a8_named_tables": Query(
        first_load_by_name,
        with_ctes("profile", "SELECT *, 'train' AS part, TRUE AS one_time FROM profile UNION ALL "
                             "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS segmentation), 'test' AS part, TRUE AS one_time FROM profile")),
    "a10_table_by_name": Query(by_name, with_ctes("silver", "SELECT * FROM silver")),
    "a13_appended_rows": Query(
        appended,
        with_ctes("silver", "SELECT * FROM c UNION ALL SELECT * FROM c",
                  c="SELECT segmentation, count(*) AS n FROM silver GROUP BY 1")),
}
