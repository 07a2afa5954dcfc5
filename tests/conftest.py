import pytest

from vanewright.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", settings={"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
