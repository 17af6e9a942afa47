import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from landfall.session import local_session
    s = local_session(cores=8, shuffle_partitions=8, app="landfall-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def meta(spark):
    from landfall.sources import fixtures as fx
    return fx.metadata_frames(spark)


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
