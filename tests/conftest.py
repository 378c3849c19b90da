import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cohortkit.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="cohortkit-tests")
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
