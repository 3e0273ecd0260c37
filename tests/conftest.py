import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from parcelle.session import get_spark
    s = get_spark("local[8]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def con():
    from oracle_harness import duck
    return duck(SF_SMALL)
