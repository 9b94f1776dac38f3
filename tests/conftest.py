import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    folder = tempfile.mkdtemp(prefix="cohortflow-tests-")
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.checkpoint.dir", f"{folder}/checkpoints")
               .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
               .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_silver(spark, sf_dir):
    from cohortflow.catalog.base import silver
    return silver(spark, sf_dir).cache()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)
    return collect
