import os
import pathlib

import pytest
from pyspark.sql import SparkSession

SMALL = "/root/testdata/sf0.001"
HERE = pathlib.Path(__file__).parent

# Python workers find the package and the models defined in tests.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(HERE.parent), str(HERE), os.environ.get("PYTHONPATH", "")]
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Call sites are not looked up while columns are built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
