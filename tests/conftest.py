import datetime as dt
import itertools

import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of():
    """The instant the sample stands at; deliberately not a midnight."""
    return dt.datetime(2024, 3, 15, 10, 0, 0)


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect


@pytest.fixture
def new_root(tmp_path):
    """A new warehouse folder per call."""
    numbers = itertools.count()
    return lambda: str(tmp_path / f"warehouse{next(numbers)}")
