import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from starloom.session import SESSION_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[4]").appName("starloom-tests")
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "4g")
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests only: a local checkpoint folder when the session names none
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="starloom-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
