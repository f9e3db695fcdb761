import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from plexus.session import local_session
    session = local_session(4, memory="6g", app="plexus-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    return duckdb.connect()
