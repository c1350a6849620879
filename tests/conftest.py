import os

import pytest

from opinara.session import build_session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def one(spark):
    """Evaluate a column over one literal row."""
    def run(make, **values):
        from pyspark.sql import functions as F
        frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
        return frame.select(make.alias("r")).first()["r"]
    return run
