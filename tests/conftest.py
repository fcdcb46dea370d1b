import os

import pytest

from tierlake.session import builder

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("tests", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
        # Two attempts per task, so that tests can lose one.
        .master("local[*, 2]")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return f"{TESTDATA}/sf0.001"
