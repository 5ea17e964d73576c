import pytest

from veilwork.session import build


@pytest.fixture(scope="session")
def spark():
    session = build(4, 4, memory="4g")
    yield session
    session.stop()
