import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from strata.session import DEFAULT_CONF
    b = (SparkSession.builder.master("local[*]").appName("strata-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh folder under the session's checkpoint root."""
    from strata.session import scratch_path
    return scratch_path(spark, "test")
