import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Apply a column function to texts, keeping their order."""
    from pyspark.sql import functions as F

    def run(function, *texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
        out = rows.select("id", function(F.col("text")).alias("out")).orderBy("id").collect()
        return [r["out"] for r in out]

    return run
