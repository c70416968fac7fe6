import pytest

from thermolake.session import build_session, ship_path


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(4, 4, "4g", **{"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    session.sparkContext.setLogLevel("ERROR")
    ship_path(session)
    yield session
    session.stop()
