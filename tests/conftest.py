from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    import __spark_entry__  # noqa: F401  (functions of the package travel with the tasks)
    from checks.session import local_session

    session = local_session("8")
    yield session
    session.stop()
