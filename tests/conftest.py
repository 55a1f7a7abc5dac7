import pytest

from cohortloom.plans.settings import Settings
from cohortloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cpus=4, partitions=4, memory="4g", shared=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def settings():
    return Settings(secret="test_key")
