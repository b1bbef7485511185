import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from brook.session import local_session

    s = local_session("*", 8, app="brook-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # a fresh folder per test; never cleared by the suite
    return tempfile.mkdtemp(prefix="brook-test-")


def _none_first(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def rows(df, *cols):
    """Rows as sorted tuples (None sorts first)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_none_first)
