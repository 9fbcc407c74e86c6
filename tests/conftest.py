import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loticote.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("scratch"))
    session = local_session(
        "8",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": scratch,
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a column function to a list of values and return the results in order."""

    def apply(kind, inputs, build):
        from pyspark.sql import functions as F

        rows = [(i, x) for i, x in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"i int, x {kind}").select("i", build(F.col("x")).alias("y"))
        return [row.y for row in df.orderBy("i").collect()]

    return apply
