import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("devdata-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def countries(spark):
    """A small country table: codes, short names, and patterns for longer names."""
    return spark.createDataFrame(
        [
            ("KEN", "KE", "Kenya", r"\bkenya"),
            ("UGA", "UG", "Uganda", r"\buganda"),
            ("ECU", "EC", "Ecuador", r"\becuador"),
            ("USA", "US", "United States", r"united\s?states|\bu\.?s\.?a\b"),
            ("GBR", "GB", "United Kingdom", r"united.?kingdom|britain"),
            ("VEN", "VE", "Venezuela", r"venezuela"),
            ("LBN", "LB", "Lebanon", r"lebanon"),
        ],
        "iso3_code STRING, iso2_code STRING, name_short STRING, regex STRING",
    )


@pytest.fixture
def rows():
    """All rows of a table as sorted tuples, for comparison without order."""

    def collect(df, *columns):
        found = (df.select(*columns) if columns else df).collect()
        return sorted((tuple(r) for r in found), key=lambda r: [(v is None, str(v)) for v in r])

    return collect
