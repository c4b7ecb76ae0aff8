import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from haulkit.session import get_spark
    s = get_spark("local[*]", 8)
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as plain tuples, sorted for order-insensitive checks."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
