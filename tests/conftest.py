import pytest

from tesserae.session import local_session, ship_package


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="tests")
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s
    s.stop()
