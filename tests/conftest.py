import sys
from datetime import timedelta
from itertools import count
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tellerlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=8, shuffle_partitions=4, shared=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def ticking():
    """A clock that moves a second at every call."""

    def make(start):
        ticks = count()
        return lambda: start + timedelta(seconds=next(ticks))

    return make
