"""CSV folders as streams: declared schema, bounded micro-batches, ingest time; one stream into good and bad rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortflow import config
from cohortflow.operators.rules import keep_valid, observed, observed_report
from cohortflow.plans import medallion


def csv_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 1) -> DataFrame:
    """New files of a folder, at most max_files per micro-batch, stamped with the batch's time."""
    return (spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", max_files)
            .csv(path).withColumn("ingest_timestamp", F.current_timestamp()))


def append_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived and stop. The checkpoint makes a second run add nothing twice."""
    return (stream.writeStream.format("parquet").outputMode("append").option("path", target)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _write_part(df: DataFrame, target: str, batch: int) -> None:
    """A micro-batch's own folder of a table, written anew should the batch come again."""
    df.write.mode("overwrite").parquet(f"{target}/batch={batch}")


def split_available(stream: DataFrame, silver: str, quarantine: str, report: str, checkpoint: str,
                    rules: Mapping[str, str] = config.ROW_RULES) -> StreamingQuery:
    """Everything that has arrived into silver and quarantine, with each batch's rule counts in report, and stop.

    A micro-batch is read once and kept for its writes. Each table has a folder per batch number (column batch), and
    a batch that was cut off between two writes comes again with the same rows and number, so no row is lost or doubled.
    """
    def split(batch: DataFrame, number: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows, seen = observed(medallion.typed(kept), rules)
            _write_part(keep_valid(rows, rules), silver, number)
            _write_part(medallion.silver_quarantine(kept, rules), quarantine, number)
            _write_part(observed_report(batch.sparkSession, seen, rules), report, number)
        finally:
            kept.unpersist()

    return stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
