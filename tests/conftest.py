import pytest

from martbrook.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
