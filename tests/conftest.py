from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("scoreloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="scoreloom-tests-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def blocked(monkeypatch):
    """Treat every sequence as one of unknown size, with blocks small enough for the test data to fill several."""
    import scoreloom.model
    from scoreloom.operators import attributes, melody, represent, split, transform

    monkeypatch.setattr(scoreloom.model, "WINDOW_ROWS", 0)
    for module in (attributes, melody, represent):
        monkeypatch.setattr(module, "BLOCK_STEPS", 24)
    for module in (split, transform):
        monkeypatch.setattr(module, "BLOCK_SECONDS", 5.0)
    monkeypatch.setattr(split, "BLOCK_CELLS", 4)
