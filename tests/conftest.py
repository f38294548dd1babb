import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from noticeworks.session import local_session

    session = local_session(4, "4g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
