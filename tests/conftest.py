import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rankforge.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="rankforge-tests")
    yield s
    s.stop()


def rows(df, cols=None):
    """Sorted plain tuples (order-insensitive comparisons)."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
