from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_point  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return entry_point.local_session()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples of the named columns."""

    def collect(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
