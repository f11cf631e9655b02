import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetpulse.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[8]", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, cols=None):
    """Rows as sorted tuples (None sorts first)."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
