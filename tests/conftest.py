import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from helixframe.session import get_session
    ckpt = tempfile.mkdtemp(prefix="helixframe-test-ckpt-")
    s = get_session("local[4]", app="helixframe-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx():
    return lambda name: os.path.join(FIXTURES, name)


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="helixframe-test-")
