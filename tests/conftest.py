import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kpiloom.session import local_session
    s = local_session(cpus=4, shuffle_partitions=4, app="kpiloom-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture(scope="session")
def staged_small(spark):
    from kpiloom.plans.registry import staged
    return staged(spark, SF_SMALL)
