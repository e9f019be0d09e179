import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from packetloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("shared")
    session = local_session(
        "tests", shuffle_partitions="4",
        spark__checkpoint__dir=str(base / "checkpoints"),
        spark__sql__warehouse__dir=str(base / "warehouse"),
    )
    yield session
    session.stop()
