import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF = os.environ.get("TABPREP_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from tabprep.session import local_session
    s = local_session("*", shuffle_partitions=8, app="tabprep-tests")
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF
