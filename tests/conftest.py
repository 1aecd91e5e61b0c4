import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stagecraft.session import build_session, shared_root
    s = build_session("local[8]", app="stagecraft-tests", shuffle_partitions=8)
    shared_root(s)  # a checkpoint folder of our own only if the session has none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from compare import duck
    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def duck_oracle():
    from compare import duck
    return duck(SF_ORACLE)
