import pytest

from parchment.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
