"""Give executors the package, so that functions sent to them can import it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()
#: Bytes of the Arrow batches that Spark hands to Python, unless the session names its own; a longer row goes alone.
BATCH_BYTES = 8 << 20
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Batches of whole texts by bytes: by rows alone they grow with the texts, in the executor and again in Python."""
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Add the package's source to the application's Python files, once per application.

    Spark serves the file to every executor, those that join later included.
    """
    context = spark.sparkContext
    if context.applicationId in _DONE:
        return
    package = Path(__file__).resolve().parents[1]
    handle, name = tempfile.mkstemp(prefix="cohortflow-", suffix=".zip")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(name)
    _DONE.add(context.applicationId)
