from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from retailflow.session import configure  # noqa: E402
from retailflow.tables import Tables  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
NOW = datetime(2024, 3, 1, 12)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    made = Tables(spark, str(tmp_path / "tables"))
    made.create()
    return made


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "scratch")
