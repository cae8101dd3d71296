import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session
    s = local_session("*", 8)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted tuples of the given columns (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
