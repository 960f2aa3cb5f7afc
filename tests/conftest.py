import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rarecast.session import get_session
    s = get_session(master="local[*]", shuffle_partitions=8, app="rarecast-tests")
    yield s


@pytest.fixture(scope="session")
def entry_mod():
    import __spark_entry__ as E
    return E
