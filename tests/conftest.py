import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kerbwatch.session import build_session

    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def boxes(spark, sf):
    """Clamped detections of the small tables, written once."""
    from kerbwatch.plans import derived
    from kerbwatch.session import materialise

    return materialise(derived.clamped(derived.detections(spark, sf)), "test-boxes")
