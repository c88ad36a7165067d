import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("CHARTFOLD_ORACLE_SF_DIR", "/root/testdata/sf0.001")

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "4g")      # one JVM runs the whole suite
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own shared folder only when the session names none
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="chartfold-test-"))
    yield s


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
