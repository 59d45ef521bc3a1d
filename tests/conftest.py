import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import tremora  # noqa: E402
import workload  # noqa: E402
from tremora.session import drop_scratch  # noqa: E402

cloudpickle.register_pickle_by_value(tremora)
cloudpickle.register_pickle_by_value(workload)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tremora-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()
