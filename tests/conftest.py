import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """A session whose Python workers cannot import this repository, as on a cluster."""
    from linkscore.runtime import local_session

    os.environ.pop("PYTHONPATH", None)
    os.chdir(tmp_path_factory.mktemp("workers"))
    return local_session("tests", "4")
