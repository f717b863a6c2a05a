import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from wxmesh.session import build_session

    scratch = tempfile.mkdtemp(prefix="wxmesh-test-")
    s = build_session("local[4]", shuffle_partitions=8, app="wxmesh-tests",
                      extra={"spark.checkpoint.dir": scratch, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    """A fresh local folder (tests write small files by hand into it)."""
    return tempfile.mkdtemp(prefix="wxmesh-t-")
