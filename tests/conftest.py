import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from merchlens.session import build_session, clear_scratch

    s = build_session("local[4]", app_name="merchlens-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    clear_scratch(s)
    s.stop()
