"""A small local session shared by all tests."""

import os

import pytest

from souk.plans.session import session

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "souk-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            # Many small plans: what is compiled once is kept, and compiled quickly.
            "spark.sql.codegen.cache.maxEntries": "2000",
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.01"
