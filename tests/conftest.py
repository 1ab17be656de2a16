import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..")
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from paperlens.session import prepare_local  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    prepare_local(session)
    return session
