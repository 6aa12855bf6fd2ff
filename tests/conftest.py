import pytest

from strataflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8,3]",  # a failed task is tried again
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("scratch")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
