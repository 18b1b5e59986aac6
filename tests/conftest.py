import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from larder.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", "8", 8)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()
