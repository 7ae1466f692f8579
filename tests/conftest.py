import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from quire.session import DEFAULTS, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[*]").appName("quire-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quire-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="quire-test-")
