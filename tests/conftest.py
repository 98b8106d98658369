import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tickertide.session import local_session

    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
