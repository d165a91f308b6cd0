import pytest

from claimstream.session import local_session, shared_folder


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4"})
    shared_folder(session)
    yield session
    session.stop()
