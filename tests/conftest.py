import pytest


@pytest.fixture(scope="session")
def spark():
    from lakefold.session import build_session

    session = build_session(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def root(spark):
    """A fresh lake folder."""
    from lakefold.session import new_scratch

    return new_scratch(spark, "test")
