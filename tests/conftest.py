import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from landcarbon.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
