from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from swinglake.session import RECOMMENDED


def make_session() -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]").appName("swinglake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
