import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gatekit.session import checkpoint_root, get_session
    s = get_session(master="local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)          # uses spark.checkpoint.dir, or a temp folder if unset
    yield s


@pytest.fixture(scope="session")
def duck():
    from oracle_check import duck as make
    return make(SF0001)
