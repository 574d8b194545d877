import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master("local[4]")
               .appName("plume-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.adaptive.enabled", "true"))
    if not os.environ.get("PLUME_KEEP_CHECKPOINT_DIR"):
        # tests only: use our own folder when the environment names none
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="plume-test-ckpt-"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="plume-test-")
