import os
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from trendloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="trendloom-tests-")
    session = build_session(
        "tests", spark__master="local[8]", spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g", spark__checkpoint__dir=f"{work}/checkpoint",
        spark__sql__warehouse__dir=f"{work}/warehouse")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column function on one value."""
    def evaluate(function, value, kind="string"):
        return spark.createDataFrame([(value,)], f"v {kind}").select(
            function(F.col("v"))).first()[0]
    return evaluate
