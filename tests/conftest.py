import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from floe.session import checkpoint_dir, local_session
    s = local_session("*", 8, app="floe-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
