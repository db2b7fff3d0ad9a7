import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tremorlake.plans import clear_scratch  # noqa: E402
from tremorlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows():
    """Sorted plain tuples of a frame."""

    def get(df, *order):
        order = order or df.columns
        return [tuple(r) for r in df.orderBy(*order).collect()]

    return get
