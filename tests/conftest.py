import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from starloom.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.maxMetadataStringLength": "2000"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def values(spark):
    """Run a column function over one column of values and give the results in order."""

    def run(function, inputs, kind="string"):
        from pyspark.sql import functions as F

        rows = [(place, value) for place, value in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"place int, v {kind}")
        return [r["r"] for r in df.select("place", function(F.col("v")).alias("r")).orderBy("place").collect()]

    return run
