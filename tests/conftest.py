import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session

    s = build_session(master="local[*]", app_name="ledgerline-tests", shuffle_partitions=8)
    # a shared checkpoint folder of our own only where the session has none
    from ledgerline.session import checkpoint_root

    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerline-test-")
