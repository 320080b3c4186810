import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from featureflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("featureflow-tests", cpus=4, spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Sorted plain tuples of a DataFrame."""

    def collect(df):
        return sorted((tuple(row) for row in df.collect()), key=repr)

    return collect
