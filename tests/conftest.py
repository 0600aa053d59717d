import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from curata.session import build_session
    ckpt = tempfile.mkdtemp(prefix="curata-test-ckpt-")
    s = build_session(master="local[*]", shuffle_partitions=8, app="curata-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


def rows(df, *cols):
    """Sorted tuples of the given columns (all when none)."""
    cols = cols or tuple(df.columns)
    data = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(data, key=lambda t: tuple((0,) if v is None else (1, v) for v in t))
