from pathlib import Path

import pytest


@pytest.fixture(scope="session")
def docs_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no test tables")
    return str(path)
