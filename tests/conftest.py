import pytest

from gleaner.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "gleaner-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
