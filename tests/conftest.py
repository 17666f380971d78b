import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from edgeframe.session import ship

    session = (
        SparkSession.builder.master("local[8]")
        .appName("edgeframe-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="edgeframe-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    ship(session)
    yield session
    session.stop()


@pytest.fixture
def fresh(spark):
    """A function giving paths nobody else uses."""
    from edgeframe.storage import scratch

    return lambda name="t": scratch(spark, name)
