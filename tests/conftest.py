import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leadframe.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4",
                            spark__driver__memory="8g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def column(spark):
    """Evaluate a column expression over a list of texts, in order."""

    def run(texts, expression):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r.v for r in rows.select("i", expression("t").alias("v")).orderBy("i").collect()]

    return run
