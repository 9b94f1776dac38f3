"""Session settings and the shared folder in which lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str, master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session with the settings the jobs here rely on; everything else is the cluster's choice."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = (builder.master(master).config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the session names, a temporary one only in local mode."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has executors of its own
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="cohortflow-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write the frame to the shared folder and go on from the written table.

    Partition-dependent columns (partition number, position) must be read back
    rather than recomputed, because a lost executor may make Spark sort again.
    The table is columnar, so later steps read only the columns they use.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
