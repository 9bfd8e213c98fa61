import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import get_session
    s = get_session("local[4]", app="tidewater-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tw-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
