import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lakeshift.session import build_session
    s = build_session("local[*]", shuffle_partitions=8)
    yield s


def rows(df, *cols):
    """Collect as a list of dicts (optionally only some columns), ordered by repr."""
    out = [r.asDict() for r in df.collect()]
    if cols:
        out = [{c: r[c] for c in cols} for r in out]
    return sorted(out, key=repr)
