import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from curate.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from curate.plans.verify import duckdb_connection
    return duckdb_connection(SF_SMALL)
