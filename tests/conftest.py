import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from certwatch.session import local_session

    return local_session(4, memory="6g")


@pytest.fixture(scope="session")
def cfg():
    from certwatch.checks.fixtures import fixture_params

    return fixture_params()
