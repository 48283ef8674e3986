from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SHARED = os.environ.get("TEST_SHARED_DIR", "/tmp/profilespark-shared")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get("TEST_CPUS", "8")}]").appName("profilespark-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", SHARED).config("spark.sql.warehouse.dir", f"{SHARED}/warehouse").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
