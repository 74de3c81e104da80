import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("cohortlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def mart8(spark):
    """Eight enrollments with hand-computed expectations."""
    from cohortlens.contract import MART_SCHEMA

    rows = []
    for i in range(8):
        failed = i < 4
        rows.append(
            (
                i + 1,
                "AAA" if i < 4 else "BBB",
                "2013J" if i % 2 == 0 else "2014J",
                "F" if i % 2 else "M",
                "North",
                "A Level or Equivalent",
                None if i == 0 else "20-30%",
                False,
                "0-35",
                0,
                60,
                -10,
                100,
                10 * i,
                i,
                i,
                i,
                int(i > 0),
                "Fail" if failed else "Pass",
                0 if failed else 1,
                0 if failed else 2,
                None if i in (0, 1, 4) else 50.0 + i,
            )
        )
    return spark.createDataFrame(rows, MART_SCHEMA)
