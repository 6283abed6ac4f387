import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from chunkwise.session import ENGINE_CONF

    builder = (
        SparkSession.builder.master("local[4]")
        .appName("chunkwise-tests")
        .config("spark.sql.shuffle.partitions", "4")
    )
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="chunkwise-test-"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from chunkwise.config import work_dir

    return work_dir(spark, "test")
