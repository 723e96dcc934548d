import pytest

from sparkloom.runtime import session


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "8")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
