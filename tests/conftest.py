import pytest

from tidemill.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("tidemill-tests", cores=8, shuffle_partitions=4)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
