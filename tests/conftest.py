import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelstride.session import local_session

    s = local_session(8, shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()
