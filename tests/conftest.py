import pytest

from depotflow.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=8,
        spark__sql__session__timeZone="UTC",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
