"""Tables by name, or by path where the target holds a slash."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def read_table(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target) if "/" in target else spark.table(target)


def table_exists(spark: SparkSession, target: str) -> bool:
    if "/" not in target:
        return spark.catalog.tableExists(target)
    try:
        spark.read.parquet(target)
    except AnalysisException:
        return False
    return True


def write_table(df: DataFrame, target: str, mode: str = "overwrite", comment: str | None = None) -> None:
    """Overwrite or append; a comment describes a named table."""
    if "/" in target:
        df.write.mode(mode).parquet(target)
        return
    df.write.mode(mode).saveAsTable(target)
    if comment is not None:
        quoted = comment.replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {target} IS '{quoted}'")


def append_rows(df: DataFrame, target: str) -> None:
    write_table(df, target, mode="append")


def first_load(frames: dict[str, DataFrame], drop: dict[str, list[str]] | None = None) -> None:
    """Overwrite several tables with one shared insert time; columns may be dropped per table."""
    if not frames:
        return
    spark = next(iter(frames.values())).sparkSession
    now = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    for target, df in frames.items():
        kept = df.drop(*(drop or {}).get(target, []))
        write_table(kept.withColumn("inserted_at", F.lit(now)), target)
