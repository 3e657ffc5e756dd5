import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from transitlens.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="transitlens-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns (or all)."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
