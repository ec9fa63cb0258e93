import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from repolens.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[4]").appName("repolens-tests") \
        .config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)  # uses spark.checkpoint.dir when the environment sets it
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="repolens-test-")
