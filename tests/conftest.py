import pytest

from locuslens.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__default__parallelism="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
