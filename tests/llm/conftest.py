import pytest

from tidemark.session import get_session


@pytest.fixture(scope="session")
def spark():
    return get_session("local[4]", shuffle_partitions=4, driver_memory="4g")
