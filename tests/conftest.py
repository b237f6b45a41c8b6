import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from viewtide.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "4g")


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(SMALL):
        pytest.skip("test data is not there")
    return SMALL


@pytest.fixture
def rows():
    """Rows as plain tuples, sorted with nulls first."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        key = lambda row: tuple((v is not None, v) for v in row)
        return sorted((tuple(row) for row in df.collect()), key=key)

    return collect
