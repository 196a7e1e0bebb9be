import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for place in (ROOT, ROOT / "tools"):
    if str(place) not in sys.path:
        sys.path.insert(0, str(place))

from brooklet.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", 4)
    yield session
    session.stop()
