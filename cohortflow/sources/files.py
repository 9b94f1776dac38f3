"""CSV in and out, and dated batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the files twice:
    meant for a first load, not for regular ones."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every row with every column as text."""
    return spark.read.option("header", True).csv(path)


def preview_csv(spark: SparkSession, path: str, rows: int = 20) -> DataFrame:
    """The first rows with every column as text."""
    return read_text_csv(spark, path).limit(rows)


def write_csv(df: DataFrame, path: str, files: int | None = None, mode: str = "errorifexists") -> None:
    df = df.repartition(files) if files else df
    df.write.mode(mode).option("header", True).csv(path)


def land_batch(df: DataFrame, path: str, batch_date: str, name: str = "batch_date") -> None:
    """Append a batch under its date; landing a date again replaces that date only."""
    (df.withColumn(name, F.lit(batch_date)).write.mode("overwrite").option("header", True)
     .option("partitionOverwriteMode", "dynamic").partitionBy(name).csv(path))
