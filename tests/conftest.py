import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from logstream.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8, app_name="logstream-tests")
    # tests run with no cluster checkpoint dir: use a fresh local one
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="logstream-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from logstream.session import new_work_dir
    return new_work_dir(spark, "test")
