import pytest

from ledgerloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "ledgerloom-tests", 4)
    yield session
    session.stop()
