import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barworks.session import build_session
    ck = tempfile.mkdtemp(prefix="barworks-test-ckpt-")
    s = build_session("local[4]", "barworks-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ck})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="barworks-test-")
