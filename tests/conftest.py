import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugeline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect as sorted tuples."""

    def collect(df, *cols):
        df = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))

    return collect
