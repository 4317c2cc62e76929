from __future__ import annotations

import pytest

from fleetwatch.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()
