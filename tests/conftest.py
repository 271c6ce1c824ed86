import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from marketflow.session import configure

    ckpt = tempfile.mkdtemp(prefix="marketflow-test-ckpt-")
    s = (SparkSession.builder.master("local[*]").appName("marketflow-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="marketflow-test-")
