import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from farebox.session import build_session
    s = build_session("local[4]", app_name="farebox-tests", shuffle_partitions=8)
    # Tests have no cluster-provided checkpoint folder: set one of our own.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="farebox-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)
