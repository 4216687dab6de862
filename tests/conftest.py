from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from lodewatch.session import local_session

    return local_session("8", shuffle_partitions=4)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of plain tuples."""

    def collect(df, *columns):
        kept = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in kept.collect()), key=repr)

    return collect
