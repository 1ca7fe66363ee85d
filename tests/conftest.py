import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session

    s = get_session("local[*]", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


def rows(df, *cols):
    """Rows as sorted tuples (optionally of selected columns)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=repr)
