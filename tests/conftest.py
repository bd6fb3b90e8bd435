import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from casewise.session import build_session
    s = build_session("local[4]", 8)
    yield s


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
