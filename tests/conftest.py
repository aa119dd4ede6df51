import pytest

from rowsmith import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "rowsmith-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
