import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from featurewright.session import checkpoint_dir, local_session

    s = local_session(cores=4, shuffle_partitions=4)
    checkpoint_dir(s)  # tests set their own folder only because none is configured
    yield s
    s.stop()
